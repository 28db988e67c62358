from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from setlake.operators import overlap as O  # noqa: E741
from setlake.operators.sets import wikidata_members, website_members

KEYS = "osm_type string, osm_id bigint"
RAW = [("way", 1001), ("way", 1002), ("way", 1002), ("relation", 2001), ("relation", 2002)]
WEB, WIKI = [("way", 1002), ("relation", 2002)], [("relation", 2001), ("relation", 2002)]


def frame(spark, rows):
    return spark.createDataFrame(rows, KEYS)


def golden(spark, raw=RAW, web=WEB, wiki=WIKI):
    return O.classified(O.universe(frame(spark, raw)), frame(spark, web), frame(spark, wiki))


def test_golden_categories(spark):
    got = {(r.osm_type, r.osm_id): r.overlap_category for r in golden(spark).collect()}
    assert got == {("way", 1001): "neither", ("way", 1002): "website_only", ("relation", 2001): "wikidata_only", ("relation", 2002): "both"}


def test_golden_summary(spark):
    assert [tuple(r) for r in O.summary(golden(spark)).collect()] == [(c, 1, 25.0) for c in ("neither", "website_only", "wikidata_only", "both")]


def test_summary_divides_before_multiplying(spark):
    rows = O.summary(golden(spark, [("way", 1), ("way", 2), ("way", 3)], [("way", 1)], [("way", 2), ("way", 3)])).collect()
    assert [r.percentage for r in rows] == [0.0, 1 / 3 * 100.0, 2 / 3 * 100.0, 0.0]


def test_empty_universe_has_four_zero_rows(spark):
    assert [(r["count"], r["percentage"]) for r in O.summary(golden(spark, [])).collect()] == [(0, 0.0)] * 4


def test_unknown_category_fails(spark):
    with pytest.raises(Exception, match="unknown overlap category"):
        O.summary(spark.createDataFrame([("odd",)], "overlap_category string")).collect()


def test_null_keys_match_nothing(spark):
    rows = golden(spark, [("way", None), (None, 1), ("way", 1)], [("way", None), ("way", 1)], [(None, 1)]).collect()
    assert {(r.osm_type, r.osm_id): r.overlap_category for r in rows} == {("way", None): "neither", (None, 1): "neither", ("way", 1): "website_only"}


def test_repeated_members_do_not_multiply(spark):
    assert golden(spark, web=WEB * 3, wiki=WIKI * 2).count() == 4


def test_orphans_intersection_and_counts(spark):
    assert [tuple(r) for r in O.orphans(frame(spark, [("way", 1), ("way", 1001)]), frame(spark, RAW)).collect()] == [("way", 1)]
    assert [tuple(r) for r in O.intersection(frame(spark, WEB), frame(spark, WIKI)).collect()] == [("relation", 2002)]
    assert {tuple(r) for r in O.occurrence_counts(frame(spark, RAW)).collect()} == {("way", 3, 2), ("relation", 2, 2)}


def test_sharded_rows_are_sorted_and_on_their_shard(spark):
    rows = O.sharded(frame(spark, [("way", i) for i in range(300, 0, -1)]), 8).withColumn("p", F.spark_partition_id()).collect()
    assert len(rows) == 300 and len({r.p for r in rows}) == 8
    for p in range(8):
        ids = [r.osm_id for r in rows if r.p == p]
        assert ids == sorted(ids)


def test_plan_broadcasts_nothing_unmeasured_and_dedups_before_joins(spark):
    plan = golden(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.rindex("Aggregate [osm_type")  # the aggregate is below the joins
    assert "strategy=broadcast" not in plan


def test_website_members(spark):
    cols = "osm_type string, osm_id string, website_text_status string, website_text string, contact_website_text_status string, contact_website_text string"
    rows = [
        ("way", "1", "success", "x", None, None), ("way", "1", "success", "x", None, None), ("way", "2", "failed", "x", "success", " x"), ("way", "3", "success", " ", "failed", "x"),
        ("way", "4", "Success", "x", None, None), ("node", "5", "success", "x", None, None), (None, "6", "success", "x", None, None), ("relation", "7", None, "x", "success", "\n"),
    ]
    got = website_members(spark.createDataFrame(rows, cols)).collect()
    assert {tuple(r) for r in got} == {("way", 1), ("way", 2), ("relation", 7)}


def test_wikidata_members_and_provenance(spark):
    links = spark.createDataFrame([("wikipedia", "a", "way", 1, "sitelink"), ("wikipedia", "a", "way", 2, "tag"), ("other", "a", "way", 3, "sitelink"), (None, "a", "way", 4, "x")], "project string, document_id string, osm_type string, osm_id int, how string")
    docs = spark.createDataFrame([("wikipedia", "a", "ok", "x"), ("wikipedia", "a", "ok", "y"), ("other", "a", "ok", "x")], "project string, document_id string, fetch_status string, full_text string")
    assert {r.osm_id for r in wikidata_members(links, docs).collect()} == {1, 2}
    assert {r.osm_id for r in wikidata_members(links, docs, F.col("how") == "sitelink").collect()} == {1}
