from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from setlake.operators import overlap as O  # noqa: E741
from setlake.plans import stored as S
from setlake.schemas import KEY
from setlake.sinks.manifest import Buckets, CommitConflictError, ManifestTable


@pytest.fixture(params=["file", "viewfs"])
def root(request, spark, tmp_path):
    """A folder as such, and behind a store that only Spark's file systems open."""
    if request.param == "file":
        return tmp_path.as_uri()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.lake.link./in", tmp_path.as_uri())
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.impl.disable.cache", "true")
    return "viewfs://lake/in"


def ids(df) -> list[int]:
    return sorted(r.id for r in df.collect())


def test_readers_follow_the_manifest(spark, root, tmp_path):
    table = ManifestTable(spark, f"{root}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.write(spark.range(100).repartition(3), metrics={"most": F.max("id")}, facts={"a": 1})
    assert (first.number, first.row_count, first.metrics, len(first.files)) == (1, 100, {"most": 99}, 3)
    assert first == table.latest() and ids(table.read()) == list(range(100))
    footers = sum(pq.read_metadata(tmp_path / "t" / first.folder / n).num_rows for n, _ in first.files)
    assert footers == first.row_count

    # a job that dies after some tasks have written
    dying = spark.range(0, 100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        table.write(dying)
    assert table.latest() == first and ids(table.read()) == list(range(100))

    # what a second attempt of a task left, after the job was over
    spark.range(5).coalesce(1).write.mode("append").parquet(f"{root}/t/{first.folder}")
    assert len(list((tmp_path / "t" / first.folder).glob("part-*"))) == 4 and ids(table.read()) == list(range(100))

    # a manifest that is half written
    second = table.write(spark.range(7))
    whole = (tmp_path / "t/manifests/00000002.json").read_text()
    (tmp_path / "t/manifests/00000003.json").write_text(whole[: len(whole) // 2])
    assert table.latest() == second and ids(table.read()) == list(range(7)) and ids(table.read(first)) == list(range(100))
    assert table.write(spark.range(8)).number == 4
    assert table.vacuum(keep=2) >= 2 and [v.number for v in table.versions()] == [4, 2] and ids(table.read()) == list(range(8))


def test_one_of_two_writers_publishes(spark, tmp_path, monkeypatch):
    one, other = (ManifestTable(spark, tmp_path.as_uri()) for _ in range(2))
    monkeypatch.setattr(other, "_numbers", lambda: [])
    one.write(spark.range(3))
    with pytest.raises(CommitConflictError):
        other.write(spark.range(4))
    assert ids(one.read()) == [0, 1, 2] and len(list((tmp_path / "parts").iterdir())) == 1


def test_lost_files_are_told(spark, tmp_path):
    table = ManifestTable(spark, tmp_path.as_uri())
    version = table.write(spark.range(3).coalesce(1))
    (tmp_path / version.folder / version.files[0][0]).unlink()
    with pytest.raises(FileNotFoundError, match="gone or changed"):
        table.read()


def test_empty_tables(spark, tmp_path):
    table = ManifestTable(spark, tmp_path.as_uri())
    assert table.write(spark.range(0)).row_count == 0 and table.read().columns == ["id"] and table.read().count() == 0


RAW = [("way", i) for i in range(1, 300)] * 2 + [("relation", i) for i in range(1, 50)] + [(None, 1), ("way", None)]
WEB = [("way", i) for i in range(1, 300, 3)] + [("way", 900)]
WIKI = [("relation", i) for i in range(1, 50, 2)] + [("way", i) for i in range(1, 300, 2)]


def stored(spark, root, buckets):
    tables = [ManifestTable(spark, f"{root}/{n}") for n in ("universe", "website", "wikidata", "overlap")]
    for table, rows in zip(tables, (RAW, WEB, WIKI), strict=False):
        S.store_keys(table, spark.createDataFrame(rows, "osm_type string, osm_id bigint"), buckets)
    return tables


def test_stored_overlap_equals_the_plain_one(spark, root, tmp_path):
    number = 128 if root.startswith("file") else 64
    tables = stored(spark, root, Buckets(number, KEY))
    frame = lambda rows: spark.createDataFrame(rows, "osm_type string, osm_id bigint")
    wanted = O.classified(O.universe(frame(RAW)), frame(WEB), frame(WIKI))
    found = S.compute_stored_overlap(*tables)
    got = tables[-1].read()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))
    assert [tuple(r) for r in S.summary_frame(spark, found).collect()] == [tuple(r) for r in O.summary(wanted).collect()]
    assert found.version.row_count == got.count() == sum(found.summary.values())
    # a shard has the files of its buckets, and no key is on another one
    files = S.shard_files(found.version)
    assert sum(map(len, files.values())) == len(found.version.files)
    for shard in (0, 5, 63):
        for name in files.get(shard, ()):
            part = spark.read.parquet(f"{root}/overlap/{found.version.folder}/{name}")
            assert part.filter(S.shard_of() != shard).count() == 0 and part.count() > 0
    # reuse: nothing is written again until an input changes
    assert S.compute_stored_overlap(*tables).version == found.version
    S.store_keys(tables[1], frame([("way", 2)]), Buckets(number, KEY))
    again = S.compute_stored_overlap(*tables)
    assert again.version.number == 2 and again.summary["website_only"] + again.summary["both"] == 1


def test_stored_tables_join_without_an_exchange(spark, tmp_path):
    tables = stored(spark, tmp_path.as_uri(), Buckets(64, KEY))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = S._classified(*(t.read() for t in tables[:3]))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    assert rows.rdd.getNumPartitions() == 64


def test_a_stray_file_costs_the_buckets_only(spark, tmp_path):
    tables = stored(spark, tmp_path.as_uri(), Buckets(64, KEY))
    version = tables[0].latest()
    spark.createDataFrame([("way", 5000)], "osm_type string, osm_id bigint").coalesce(1).write.mode("append").parquet(f"{tmp_path.as_uri()}/universe/{version.folder}")
    assert tables[0].read().filter("osm_id = 5000").count() == 0 and tables[0].read().count() == version.row_count


def test_buckets_grow_with_the_rows():
    assert S.buckets_for(0).number == 64 and S.buckets_for(64 * S.BUCKET_ROWS).number == 64
    assert S.buckets_for(64 * S.BUCKET_ROWS + 1).number == 128 and S.buckets_for(10**11).number * S.BUCKET_ROWS >= 10**11


def test_unpublished_inputs_are_told(spark, tmp_path):
    tables = [ManifestTable(spark, f"{tmp_path.as_uri()}/{n}") for n in "abcd"]
    with pytest.raises(O.OverlapError, match="universe, website, wikidata"):
        S.compute_stored_overlap(*tables)
