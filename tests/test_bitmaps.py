from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from setlake.operators import bitmaps as B
from setlake.operators import overlap as O  # noqa: E741

KEYS = "osm_type string, osm_id bigint"
EDGES = [0, 1, 63, 64, 127, -1, -64, -65, (1 << 63) - 1, -(1 << 63), 1 << 40]


def sets(seed: int) -> list[list[tuple]]:
    """Dense and sparse ids, edges of words and of longs, repeats and nulls."""
    rng = random.Random(seed)
    pool = [(k, i) for k in ("way", "relation") for i in [*range(150), *EDGES, *(rng.randrange(-(10**15), 10**15) for _ in range(80))]]
    odd = [(None, 1), ("way", None), (None, None)]
    return [rng.choices(pool + odd, k=n) + (odd if rng.random() < 0.7 else []) for n in (500, 120, 200)]


@pytest.mark.parametrize("seed", range(2))
def test_bitmaps_equal_joins(spark, seed):
    raw, a, b = (spark.createDataFrame(rows, KEYS).repartition(3) for rows in sets(seed))
    rows = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    wanted = O.classified(O.universe(raw), a, b)
    assert rows(B.classified(raw, a, b)) == rows(wanted)
    assert [tuple(r) for r in B.summary(raw, a, b).collect()] == [tuple(r) for r in O.summary(wanted).collect()]
    assert rows(B.by_type(raw, a, b)) == rows(wanted.groupBy("osm_type", "overlap_category").agg(F.count(F.lit(1)).alias("count")))


def test_bitmaps_of_nothing(spark):
    none = spark.createDataFrame([], KEYS)
    some = spark.createDataFrame([("way", 1)], KEYS)
    assert [(r["count"], r.percentage) for r in B.summary(none, some, none).collect()] == [(0, 0.0)] * 4
    assert B.classified(none, some, some).count() == 0 and B.by_type(none, some, none).count() == 0


def test_bitmaps_shuffle_words_and_join_nothing(spark):
    raw = spark.range(1_000_000).select(F.lit("way").alias("osm_type"), F.col("id").alias("osm_id"))
    some = raw.filter("osm_id % 3 = 0")
    plan = B.summary(raw, some, some)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(kind") == 1
    words = B.membership_words(raw, some, some)
    assert words.count() == 1_000_000 // 64  # rows after the shuffle; before it each task has its own words only
    assert B.summary(raw, some, some).first()["count"] == 1_000_000 - 333_334
