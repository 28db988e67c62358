from __future__ import annotations

import random

from setlake.operators import overlap as O  # noqa: E741
from setlake.streaming.categories import CHANGES, current, follow_categories, state_size

KEYS = "osm_type string, osm_id bigint"


def test_categories_follow_their_inputs(spark, tmp_path):
    """Increments in any order, members before their identities, repeats, negative ids and nulls; each change is told once."""
    rng = random.Random(3)
    pool = [(k, i) for k in ("way", "relation") for i in [*range(-70, 140), 1 << 50, -(1 << 62)]]
    folders = [tmp_path / n for n in ("raw", "a", "b")]
    held: list[list] = [[], [], []]
    put = lambda i, rows: spark.createDataFrame(rows, KEYS).coalesce(1).write.mode("append").parquet(folders[i].as_uri())
    for i in range(3):
        put(i, [])
    run = lambda: follow_categories(spark, *(f.as_uri() for f in folders), (tmp_path / "out").as_uri(), (tmp_path / "checkpoint").as_uri())
    read = lambda: spark.read.schema(CHANGES).parquet((tmp_path / "out").as_uri())
    for step in ((1, 0), (0, 2), (0, 1, 2)):
        for i in step:
            rows = rng.choices(pool, k=120) + [(None, 5), ("way", None)]
            held[i] += rows
            put(i, rows)
        query = run()
        query.awaitTermination()
        raw, a, b = (spark.createDataFrame([r for r in rows if None not in r], KEYS) for rows in held)
        wanted = O.classified(O.universe(raw), a, b)
        rows = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
        assert rows(current(read())) == rows(wanted)
    size = state_size(query)
    assert 0 < size["words"] <= 2 * 8 and size["bytes"] > 0
    told = read().collect()
    assert len({(r.osm_type, r.osm_id, r.change) for r in told}) == len(told)
    # the same rows again change nothing
    put(0, held[0])
    run().awaitTermination()
    assert len(read().collect()) == len(told)
