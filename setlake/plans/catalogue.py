"""Registered queries: every relational operator of the engine over the driver's tables, with DuckDB SQL beside it.

Raw occurrences are customers of orders and suppliers of line items; set A has two alternative status
and text rules; set B comes from purchase events and line items.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlake.functions import predicates as P
from setlake.operators import bitmaps as B
from setlake.operators import overlap as O  # noqa: E741
from setlake.operators import sets as S
from setlake.plans.extract import scan
from setlake.plans.stored import buckets_for, compute_stored_overlap, store_keys, summary_frame
from setlake.schemas import IDENTITY
from setlake.session import scratch
from setlake.sinks.manifest import ManifestTable
from setlake.sinks.pbf import write_pbf
from setlake.sources.files import parquet_files, read_union
from setlake.sources.pbf_function import register_function, stretches
from setlake.sources.text import WebsiteSource, WikidataSource
from setlake.streaming.categories import CHANGES, current, follow_categories
from setlake.streaming.universe import grow_universe

KEY = ("entity_type", "entity_id")
NAMES = ("in_a", "in_b")
LABELS = ("neither", "a_only", "b_only", "both")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keyed(df: DataFrame, kind: str, ident: str) -> DataFrame:
    return df.select(F.lit(kind).alias("entity_type"), F.col(ident).cast("bigint").alias("entity_id"))


def occurrences(spark: SparkSession, d: str) -> DataFrame:
    return _keyed(_table(spark, d, "orders"), "customer", "o_custkey").unionByName(_keyed(_table(spark, d, "lineitem"), "supplier", "l_suppkey"))


def _a_rule() -> Column:
    text = P.text_present(F.col("o_orderpriority"))
    return ((F.col("o_orderstatus") == "F") & text & (F.col("o_totalprice") > 400000)) | ((F.col("o_orderstatus") == "P") & text & (F.col("o_totalprice") < 2000))


def _rows_a(spark: SparkSession, d: str) -> DataFrame:
    orders = _keyed(_table(spark, d, "orders").filter(_a_rule()), "customer", "o_custkey")
    items = _table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity >= 50 AND l_discount >= 0.1")
    return orders.unionByName(_keyed(items, "supplier", "l_suppkey"))


def _rows_b(spark: SparkSession, d: str) -> DataFrame:
    events = _keyed(_table(spark, d, "events").filter("event_type = 'purchase'"), "customer", "user_id")
    items = _table(spark, d, "lineitem").filter("l_linestatus = 'O' AND l_quantity = 1 AND l_tax = 0")
    return events.unionByName(_keyed(items, "supplier", "l_suppkey"))


def set_a(spark: SparkSession, d: str) -> DataFrame:
    return S.distinct_keys(_rows_a(spark, d), KEY)


def set_b(spark: SparkSession, d: str) -> DataFrame:
    return S.distinct_keys(_rows_b(spark, d), KEY)


def _universe(spark: SparkSession, d: str) -> DataFrame:
    return O.universe(occurrences(spark, d), key=KEY)


def _rows(spark: SparkSession, d: str, keys: DataFrame | None = None) -> DataFrame:
    return O.classified(_universe(spark, d) if keys is None else keys, set_a(spark, d), set_b(spark, d), NAMES, LABELS, KEY)


_LINKS = "SELECT l_linestatus AS project, l_orderkey AS document_id, 'supplier' AS entity_type, l_suppkey AS entity_id FROM lineitem WHERE l_linestatus IN ('F', 'O')"
_DOCS = "SELECT o_orderstatus AS project, o_orderkey AS document_id FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT' AND o_totalprice > 490000"


def _links(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    links = _table(spark, d, "lineitem").select(F.col("l_linestatus").alias("project"), F.col("l_orderkey").alias("document_id"), F.lit("supplier").alias("entity_type"), F.col("l_suppkey").alias("entity_id"))
    docs = _table(spark, d, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 490000)).select(F.col("o_orderstatus").alias("project"), F.col("o_orderkey").alias("document_id"))
    wanted = F.col("project").isin("F", "O")
    return links.filter(wanted), docs.filter(wanted)


_LATE = """l AS (SELECT DISTINCT 'customer' AS entity_type, o_custkey AS entity_id FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 250000
    UNION SELECT 'supplier', l_suppkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity >= 50 AND l_tax = 0)"""


def _smaller_universe(spark: SparkSession, d: str) -> DataFrame:
    """Keys of a part of the occurrences, so that both sets have members outside."""
    orders = _table(spark, d, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 250000")
    items = _table(spark, d, "lineitem").filter("l_returnflag = 'A' AND l_quantity >= 50 AND l_tax = 0")
    return O.universe(_keyed(orders, "customer", "o_custkey"), _keyed(items, "supplier", "l_suppkey"), key=KEY)


_R = "r AS (SELECT 'customer' AS entity_type, o_custkey AS entity_id FROM orders UNION ALL SELECT 'supplier', l_suppkey FROM lineitem)"
_A = """a AS (SELECT DISTINCT 'customer' AS entity_type, o_custkey AS entity_id FROM orders
    WHERE (o_orderstatus = 'F' AND length(trim(coalesce(o_orderpriority, ''))) > 0 AND o_totalprice > 400000)
       OR (o_orderstatus = 'P' AND length(trim(coalesce(o_orderpriority, ''))) > 0 AND o_totalprice < 2000)
    UNION SELECT 'supplier', l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50 AND l_discount >= 0.1)"""
_B = """b AS (SELECT DISTINCT 'customer' AS entity_type, user_id AS entity_id FROM events WHERE event_type = 'purchase'
    UNION SELECT 'supplier', l_suppkey FROM lineitem WHERE l_linestatus = 'O' AND l_quantity = 1 AND l_tax = 0)"""
_U = "u AS (SELECT DISTINCT entity_type, entity_id FROM r)"
_F = """f AS (SELECT u.entity_type, u.entity_id, a.entity_id IS NOT NULL AS in_a, b.entity_id IS NOT NULL AS in_b
    FROM u LEFT JOIN a USING (entity_type, entity_id) LEFT JOIN b USING (entity_type, entity_id))"""
_C = """c AS (SELECT *, CASE WHEN in_a AND in_b THEN 'both' WHEN in_a THEN 'a_only' WHEN in_b THEN 'b_only' ELSE 'neither' END AS overlap_category FROM f)"""
_WITH = f"WITH {_R}, {_A}, {_B}, {_U}, {_F}, {_C} "
_SUMMARY = """, k AS (SELECT d.overlap_category, count(s.overlap_category) AS count FROM (VALUES ('neither'), ('a_only'), ('b_only'), ('both')) AS d(overlap_category)
    LEFT JOIN {0} s USING (overlap_category) GROUP BY ALL)
    SELECT overlap_category, count, CASE WHEN sum(count) OVER () > 0 THEN count / sum(count) OVER () * 100.0 ELSE 0.0 END::DOUBLE AS percentage FROM k"""


def scan_project_key(spark, d):
    """Projection and cast of keys."""
    return _keyed(_table(spark, d, "orders"), "customer", "o_custkey")


def filter_type_in(spark, d):
    """Membership of a column in a fixed list."""
    return _table(spark, d, "events").filter(F.col("event_type").isin("click", "purchase")).select("event_id", "event_type")


def filter_status_text(spark, d):
    """Status equality with text present."""
    return _table(spark, d, "orders").filter(P.successful(F.col("o_orderstatus"), F.col("o_orderpriority"), "F")).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def filter_dual_field_or(spark, d):
    """Either of two status and text rules."""
    return _table(spark, d, "orders").filter(_a_rule()).select("o_orderkey", "o_orderstatus", "o_totalprice")


def text_blank_variants(spark, d):
    """Which strings count as blank: by nation a customer's text is null, empty, one of several blanks, a name among blanks, or a name."""
    nation, blanks = F.col("c_nationkey"), [F.lit(x) for x in (None, "", " ", "\u00a0", "\u3000", "\t", "\n")]
    text = F.concat(F.lit(" \u2003"), "c_mktsegment", F.lit("\u00a0"))
    for i, blank in enumerate(blanks):
        text = F.when(nation == i, blank).otherwise(text)
    return _table(spark, d, "customer").select("c_custkey", P.text_present(text).alias("present"))


def membership_a(spark, d):
    """Distinct keys of the first set."""
    return set_a(spark, d)


def membership_b(spark, d):
    """Distinct keys of the second set."""
    return set_b(spark, d)


def membership_link_semi(spark, d):
    """Keys with a link to a wanted document."""
    return S.linked_members(*_links(spark, d), key=KEY)


def link_join_multiplicity(spark, d):
    """The inner join that the semi join stands for, with its multiplicity."""
    links, docs = _links(spark, d)
    return links.join(docs, ["project", "document_id"]).select("project", "document_id", *KEY)


def universe_distinct(spark, d):
    """Distinct keys of all occurrences."""
    return _universe(spark, d)


def occurrence_counts(spark, d):
    """Occurrences and identities per type."""
    return O.occurrence_counts(occurrences(spark, d), "entity_type", KEY)


def left_join_flags(spark, d):
    """A flag per set for every key."""
    return O.flagged(_universe(spark, d), set_a(spark, d), set_b(spark, d), NAMES, KEY)


def overlap_rows(spark, d):
    """Flags and category of every key."""
    return _rows(spark, d)


def overlap_summary(spark, d):
    """Count and percentage of every category, by bitmaps."""
    return B.summary(occurrences(spark, d), _rows_a(spark, d), _rows_b(spark, d), LABELS, KEY)


def overlap_summary_of_rows(spark, d):
    """The same from classified rows."""
    return O.summary(_rows(spark, d), LABELS)


def overlap_rows_by_bitmaps(spark, d):
    """Flags and category of every key without a join."""
    return B.classified(occurrences(spark, d), _rows_a(spark, d), _rows_b(spark, d), NAMES, LABELS, KEY)


def overlap_summary_empty(spark, d):
    """The same over no keys: four rows of zeros."""
    return O.summary(_rows(spark, d, _universe(spark, d).filter("entity_id < 0")), LABELS)


def overlap_by_type(spark, d):
    """Category counts per type, by bitmaps."""
    return B.by_type(occurrences(spark, d), _rows_a(spark, d), _rows_b(spark, d), LABELS, KEY)


def _category(label: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _rows(spark, d).filter(F.col("overlap_category") == label).select(*KEY)


def orphan_members(spark, d):
    """Members outside a smaller universe."""
    return O.orphans(set_a(spark, d), _smaller_universe(spark, d), KEY)


def _portable_shard() -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", "entity_type", F.col("entity_id").cast("string"))), 31, 2), 16, 10).cast("bigint") % 64


def shard_histogram(spark, d):
    """Keys per shard, by a hash that other engines have too."""
    return _universe(spark, d).groupBy(_portable_shard().alias("shard_id")).agg(F.count(F.lit(1)).alias("count"))


def shard_sorted_rows(spark, d):
    """Classified rows dealt to shards and sorted within."""
    return _rows(spark, d).withColumn("shard_id", _portable_shard()).repartitionById(64, F.col("shard_id").cast("int")).sortWithinPartitions(*KEY)


def _ways(spark: SparkSession, d: str) -> DataFrame:
    """Orders as ways: their parts by line number, closed by the first where an item has a quantity over 10."""
    refs = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    ways = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(refs.alias("refs"), F.max("l_quantity").alias("most"))
    return ways.select(F.lit("way").alias("osm_type"), F.col("l_orderkey").alias("osm_id"), F.when(F.col("most") > 10, F.concat("refs", F.slice("refs", 1, 1))).otherwise(F.col("refs")).alias("refs"))


def _areas(spark: SparkSession, d: str) -> DataFrame:
    """Parts as relations: two kinds of areas by size, another kind, and a kind that differs in case."""
    tag = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    kind = F.when(F.col("p_size") < 10, "multipolygon").when(F.col("p_size") < 20, "boundary").when(F.col("p_size") < 30, "route").otherwise("Boundary")
    return _table(spark, d, "part").select(F.lit("relation").alias("osm_type"), F.col("p_partkey").alias("osm_id"), F.array(tag("name", F.col("p_name")), tag("type", kind)).alias("tags"))


def ring_predicate(spark, d):
    """Both ring rules over references."""
    return _ways(spark, d).select("osm_id", *[P.closed_ring(F.col("refs"), r).alias(r) for r in P.RING_RULES])


def relation_predicate(spark, d):
    """Which tag lists make an area."""
    return _areas(spark, d).select("osm_id", P.area_relation(F.col("tags")).alias("is_area"))


def union_by_name_drift(spark, d):
    """Union by name of two tables, one lacking a column."""
    full = _table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return full.unionByName(_table(spark, d, "supplier").select(F.col("s_suppkey").alias("id")), allowMissingColumns=True)


def inventory_intersection(spark, d):
    """Keys in both sets, whether in the universe or not."""
    return O.intersection(set_a(spark, d), set_b(spark, d), KEY)


def alignment_gap(spark, d):
    """How many members of each set are in the universe."""
    keys = _smaller_universe(spark, d).withColumn("_in", F.lit(1))
    both = set_a(spark, d).withColumn("member_set", F.lit("a")).unionByName(set_b(spark, d).withColumn("member_set", F.lit("b")))
    return both.join(keys, list(KEY), "left").groupBy("member_set").agg(F.count(F.lit(1)).alias("members"), F.count("_in").alias("in_universe"))


def alignment_rows(spark, d):
    """The members of each set, with whether they are in the universe."""
    keys = _smaller_universe(spark, d)
    sets = [O.flagged(members, keys, keys, ("in_universe", "_again"), KEY).select(F.lit(name).alias("member_set"), *KEY, "in_universe") for name, members in (("a", set_a(spark, d)), ("b", set_b(spark, d)))]
    return sets[0].unionByName(sets[1])


def strict_membership(spark, d):
    """Link membership with a provenance rule on the links."""
    links, docs = _links(spark, d)
    return S.linked_members(links.filter("project = 'F'"), docs, key=KEY)


def text_overlap(spark, d):
    """Categories of documents by two label rules, keyed by language and id."""
    docs = _table(spark, d, "documents").select(F.col("lang").alias("entity_type"), F.col("doc_id").alias("entity_id"), "n_chars")
    labels = _table(spark, d, "labels").withColumnRenamed("doc_id", "entity_id")
    joined = docs.join(labels, "entity_id")
    return O.summary(O.classified(S.distinct_keys(docs, KEY), joined.filter("quality = 1").select(*KEY), joined.filter("toxic = 0 AND n_chars > 200").select(*KEY), NAMES, LABELS, KEY), LABELS)


def _folder(spark: SparkSession, name: str) -> Path:
    """A new folder in the shared one; the file sources need one that is mounted."""
    path = scratch(spark, name)
    if "://" in path and not path.startswith("file://"):
        raise RuntimeError(f"source trees need a mounted shared folder, not {path}")
    return Path(path.removeprefix("file://"))


def _put(df: DataFrame, folder: Path) -> None:
    """Add ``df`` to a folder of Parquet files, whatever the schema of the others."""
    df.write.mode("append").parquet(folder.as_uri())


def website_source(spark, d):
    """The website source over files whose keys drift from text to two widths of integers: validation, union by name, both status and text pairs."""
    root = _folder(spark, "website")
    status = lambda c, ok: F.when(F.col(c) == ok, "success").when(F.col(c).isNotNull(), "failed")
    orders = _table(spark, d, "orders").select(F.lit("way").alias("osm_type"), F.col("o_custkey").alias("osm_id"), status("o_orderstatus", "F").alias("website_text_status"), F.when(F.col("o_totalprice") > 400000, F.col("o_orderpriority")).otherwise(" ").alias("website_text"),
        status("o_orderstatus", "P").alias("contact_website_text_status"), F.when(F.col("o_totalprice") < 2000, F.col("o_orderpriority")).alias("contact_website_text"))
    items = _table(spark, d, "lineitem").filter("l_quantity >= 50")
    texts = [status("l_returnflag", "R").alias("website_text_status"), F.when(F.col("l_discount") >= 0.1, F.col("l_linestatus")).alias("website_text"), F.lit(None).cast("string").alias("contact_website_text_status"), F.lit(None).cast("string").alias("contact_website_text")]
    _put(orders, root / "polygons")
    _put(items.select(F.lit("relation").alias("osm_type"), F.col("l_suppkey").cast("string").alias("osm_id"), *texts), root / "polygons")
    _put(items.select(F.lit("node").alias("osm_type"), F.col("l_linenumber").alias("osm_id"), *reversed(texts), F.lit(1).alias("more")), root / "polygons")
    return WebsiteSource.validate(root).members(spark)


def wikidata_source(spark, d):
    """The link and document source: a project's documents in its own folder, links to all, a third project that is not read."""
    root = _folder(spark, "wikidata")
    project = lambda c: F.when(F.col(c) == "O", "wikipedia").when(F.col(c) == "F", "wikivoyage").otherwise("other").alias("project")
    links = _table(spark, d, "lineitem").select(project("l_linestatus"), F.col("l_orderkey").cast("string").alias("document_id"), F.when(F.col("l_returnflag") == "A", "node").otherwise("relation").alias("osm_type"), F.col("l_suppkey").cast("int").alias("osm_id"))
    docs = _table(spark, d, "orders").select(project("o_orderstatus"), F.col("o_orderkey").cast("string").alias("document_id"), F.when(F.col("o_totalprice") > 490000, "ok").otherwise("error").alias("fetch_status"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise(" ").alias("full_text"))
    _put(links, root / "polygon_document_links")
    for name in ("wikipedia", "wikivoyage", "other"):
        _put(docs.filter(F.col("project") == name), root / name / "documents")
    return WikidataSource.validate(root).members(spark)


def read_union_drift(spark, d):
    """Files of four schemas as one table: united by name, absent columns null, keys of all types as integers."""
    root = _folder(spark, "drift")
    customers = _table(spark, d, "customer")
    _put(customers.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")), root)
    _put(customers.select(F.col("c_name").alias("name"), (F.col("c_custkey") + F.lit(0.5)).cast("decimal(20,1)").alias("id")), root)
    _put(_table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.lit(1).alias("unread")), root)
    _put(_table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("segment")), root)
    return read_union(spark, parquet_files(root, "drift"), ("id", "segment", "name"), ("id",))


def sharded_rows(spark, d):
    """Classified rows as they are stored: dealt to 64 shards by key and sorted within. Tells whether each lies on its shard."""
    rows = _rows(spark, d).withColumnsRenamed({"entity_type": "osm_type", "entity_id": "osm_id"})
    return O.sharded(rows, 64).withColumn("on_its_shard", F.spark_partition_id() == P.shard(F.col("osm_type"), F.col("osm_id"), 64))


def _pbf_files(spark: SparkSession, d: str) -> list[Path]:
    """Orders and parts as PBF files."""
    return write_pbf(_ways(spark, d).unionByName(_areas(spark, d), allowMissingColumns=True), _folder(spark, "pbf"))


def _pbf(spark: SparkSession, d: str, ring_rule: str = "first3") -> DataFrame:
    """Orders and parts written as PBF files and scanned, in stretches far smaller than a file."""
    return scan(spark, _pbf_files(spark, d), ring_rule, split_bytes=1 << 16)


def pbf_identities(spark, d):
    """The PBF source over files of orders as ways and parts as relations: ids of closed ways and areas."""
    return _pbf(spark, d).select("osm_type", "osm_id")


def pbf_loose_rings(spark, d):
    """The same by the looser ring rule, with a filter that the source takes over: relations stay undecoded."""
    return _pbf(spark, d, "distinct3").filter("osm_type = 'way'").select("osm_id")


def pbf_scan_function(spark, d):
    """The scanner as a table function of SQL, over the same files."""
    register_function(spark)
    cuts = stretches(spark, _pbf_files(spark, d), split_bytes=1 << 16)
    return spark.sql("SELECT osm_type, osm_id FROM pbf_scan(TABLE({cuts}), 'identities', 'first3')", cuts=cuts)


def _stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Rows and summary of the overlap over stored, bucketed tables that manifests commit; the sets stored in two versions, of which the last counts."""
    root, buckets = scratch(spark, "stored"), buckets_for(0)
    tables = [ManifestTable(spark, f"{root}/{name}") for name in ("universe", "website", "wikidata", "overlap")]
    named = lambda df: df.withColumnsRenamed({"entity_type": "osm_type", "entity_id": "osm_id"})
    store_keys(tables[1], named(set_b(spark, d)), buckets)
    for table, rows in zip(tables, (occurrences(spark, d), set_a(spark, d), set_b(spark, d)), strict=False):
        store_keys(table, named(rows), buckets)
    found = compute_stored_overlap(*tables)
    return tables[-1].read(), summary_frame(spark, found)


def stored_overlap_rows(spark, d):
    """Classified rows as stored: three bucketed inputs joined without an exchange."""
    return _stored(spark, d)[0]


def stored_overlap_summary(spark, d):
    """The summary as it was counted while the rows were written."""
    return _stored(spark, d)[1]


def stream_universe(spark, d):
    """The universe as a stream that is run twice: each run takes in the files that came since."""
    root = _folder(spark, "stream")
    raw, out, checkpoint = (root / n for n in ("raw", "out", "checkpoint"))
    for name in ("orders", "lineitem"):
        key = "o_custkey" if name == "orders" else "l_suppkey"
        kind = "way" if name == "orders" else "relation"
        _put(_table(spark, d, name).select(F.lit(kind).alias("osm_type"), F.col(key).alias("osm_id")), raw)
        grow_universe(spark, raw.as_uri(), out.as_uri(), checkpoint.as_uri()).awaitTermination()
    return spark.read.schema(IDENTITY).parquet(out.as_uri())


def stream_categories(spark, d):
    """Categories that follow three streams over three increments: customers with the first set, suppliers, the second set."""
    root = _folder(spark, "categories")
    raw, a, b, out, checkpoint = (root / n for n in ("raw", "a", "b", "out", "checkpoint"))
    named = lambda df: df.select(F.col("entity_type").alias("osm_type"), F.col("entity_id").alias("osm_id"))
    for folder in (raw, a, b):
        _put(named(occurrences(spark, d)).limit(0), folder)
    increments = ([(occurrences(spark, d).filter("entity_type = 'customer'"), raw), (_rows_a(spark, d), a)], [(occurrences(spark, d).filter("entity_type = 'supplier'"), raw)], [(_rows_b(spark, d), b)])
    for increment in increments:
        for rows, folder in increment:
            _put(named(rows), folder)
        follow_categories(spark, *(p.as_uri() for p in (raw, a, b, out, checkpoint))).awaitTermination()
    return current(spark.read.schema(CHANGES).parquet(out.as_uri()))


_WAYS = """w AS (SELECT l_orderkey AS id, list(l_partkey ORDER BY l_linenumber, l_partkey) AS p, max(l_quantity) AS most FROM lineitem GROUP BY l_orderkey),
    r AS (SELECT id, CASE WHEN most > 10 THEN list_append(p, p[1]) ELSE p END AS r FROM w)"""
_FIRST3 = "(len(r) >= 3 AND r[1] <> r[2] AND r[1] <> r[3] AND r[2] <> r[3] AND r[-1] = r[1])"
_DISTINCT3 = "(len(r) >= 4 AND r[-1] = r[1] AND len(list_distinct(r[1:len(r) - 1])) >= 3)"
_STORED = _WITH + """, o AS (SELECT entity_type AS osm_type, entity_id AS osm_id, in_a AS website, in_b AS wikidata,
    CASE overlap_category WHEN 'a_only' THEN 'website_only' WHEN 'b_only' THEN 'wikidata_only' ELSE overlap_category END AS overlap_category FROM c) """

_SQL = {
    "website_source": """SELECT DISTINCT 'way' AS osm_type, o_custkey AS osm_id FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice > 400000) OR (o_orderstatus = 'P' AND o_totalprice < 2000)
        UNION SELECT 'relation', l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_returnflag = 'R' AND l_discount >= 0.1""",
    "wikidata_source": """SELECT DISTINCT 'relation' AS osm_type, l_suppkey AS osm_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus
        WHERE l_returnflag <> 'A' AND l_linestatus IN ('O', 'F') AND o_totalprice > 490000 AND o_orderpriority <> '5-LOW'""",
    "read_union_drift": """SELECT c_custkey AS id, c_mktsegment AS segment, c_name AS name FROM customer UNION ALL SELECT CAST(c_custkey + 0.5 AS DECIMAL(20, 1))::BIGINT, NULL, c_name FROM customer
        UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier UNION ALL SELECT n_nationkey, n_regionkey::VARCHAR, NULL FROM nation""",
    "sharded_rows": _WITH + "SELECT entity_type AS osm_type, entity_id AS osm_id, in_a, in_b, overlap_category, true AS on_its_shard FROM c",
    "pbf_identities": f"""WITH {_WAYS} SELECT 'way' AS osm_type, id AS osm_id FROM r WHERE {_FIRST3} AND id > 0 UNION ALL SELECT 'relation', p_partkey FROM part WHERE p_size < 20 AND p_partkey > 0""",
    "pbf_scan_function": f"""WITH {_WAYS} SELECT 'way' AS osm_type, id AS osm_id FROM r WHERE {_FIRST3} AND id > 0 UNION ALL SELECT 'relation', p_partkey FROM part WHERE p_size < 20 AND p_partkey > 0""",
    "pbf_loose_rings": f"WITH {_WAYS} SELECT id AS osm_id FROM r WHERE {_DISTINCT3} AND id > 0",
    "ring_predicate": f"WITH {_WAYS} SELECT id AS osm_id, coalesce({_FIRST3}, false) AS first3, coalesce({_DISTINCT3}, false) AS distinct3 FROM r",
    "relation_predicate": "SELECT p_partkey AS osm_id, p_size < 20 AS is_area FROM part",
    "stored_overlap_rows": _STORED + "SELECT osm_type, osm_id, website, wikidata, overlap_category FROM o",
    "stream_categories": _STORED + "SELECT osm_type, osm_id, website, wikidata, overlap_category FROM o",
    "stored_overlap_summary": _STORED + _SUMMARY.format("o").replace("'a_only'", "'website_only'").replace("'b_only'", "'wikidata_only'"),
    "stream_universe": "SELECT DISTINCT 'way' AS osm_type, o_custkey AS osm_id FROM orders UNION SELECT 'relation', l_suppkey FROM lineitem",
    "scan_project_key": "SELECT 'customer' AS entity_type, CAST(o_custkey AS BIGINT) AS entity_id FROM orders",
    "filter_type_in": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')",
    "filter_status_text": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND length(trim(coalesce(o_orderpriority, ''))) > 0",
    "filter_dual_field_or": """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE length(trim(coalesce(o_orderpriority, ''))) > 0
        AND ((o_orderstatus = 'F' AND o_totalprice > 400000) OR (o_orderstatus = 'P' AND o_totalprice < 2000))""",
    "text_blank_variants": """SELECT c_custkey, length(trim(coalesce(CASE c_nationkey WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' WHEN 3 THEN chr(160) WHEN 4 THEN chr(12288) WHEN 5 THEN chr(9) WHEN 6 THEN chr(10)
        ELSE ' ' || chr(8195) || c_mktsegment || chr(160) END, ''))) > 0 AS present FROM customer""",
    "membership_a": f"WITH {_A} SELECT * FROM a",
    "membership_b": f"WITH {_B} SELECT * FROM b",
    "membership_link_semi": f"SELECT DISTINCT entity_type, entity_id FROM ({_LINKS}) JOIN ({_DOCS}) USING (project, document_id)",
    "link_join_multiplicity": f"SELECT project, document_id, entity_type, entity_id FROM ({_LINKS}) JOIN ({_DOCS}) USING (project, document_id)",
    "universe_distinct": _WITH + "SELECT * FROM u",
    "occurrence_counts": _WITH + "SELECT entity_type, count(*) AS occurrences, count(DISTINCT entity_id) AS identities FROM r GROUP BY entity_type",
    "left_join_flags": _WITH + "SELECT * FROM f",
    "overlap_rows": _WITH + "SELECT * FROM c",
    "overlap_summary": _WITH + _SUMMARY.format("c"),
    "overlap_summary_of_rows": _WITH + _SUMMARY.format("c"),
    "overlap_rows_by_bitmaps": _WITH + "SELECT * FROM c",
    "overlap_summary_empty": _WITH + _SUMMARY.format("(SELECT * FROM c WHERE entity_id < 0)"),
    "overlap_by_type": _WITH + "SELECT entity_type, overlap_category, count(*) AS count FROM c GROUP BY ALL",
    "category_both": _WITH + "SELECT * FROM u INTERSECT SELECT * FROM a INTERSECT SELECT * FROM b",
    "category_a_only": _WITH + "(SELECT * FROM u INTERSECT SELECT * FROM a) EXCEPT SELECT * FROM b",
    "category_b_only": _WITH + "(SELECT * FROM u INTERSECT SELECT * FROM b) EXCEPT SELECT * FROM a",
    "category_neither": _WITH + "SELECT * FROM u EXCEPT (SELECT * FROM a UNION SELECT * FROM b)",
    "orphan_members": f"WITH {_A}, {_LATE} SELECT * FROM a EXCEPT SELECT * FROM l",
    "shard_histogram": _WITH + "SELECT ('0x' || substr(md5(entity_type || ':' || entity_id), 31, 2))::BIGINT % 64 AS shard_id, count(*) AS count FROM u GROUP BY 1",
    "shard_sorted_rows": _WITH + "SELECT *, ('0x' || substr(md5(entity_type || ':' || entity_id), 31, 2))::BIGINT % 64 AS shard_id FROM c",
    "union_by_name_drift": "SELECT c_custkey AS id, c_mktsegment AS segment FROM customer UNION ALL BY NAME SELECT s_suppkey AS id FROM supplier",
    "inventory_intersection": _WITH + "SELECT * FROM a INTERSECT SELECT * FROM b",
    "alignment_gap": f"WITH {_A}, {_B}, {_LATE}" + """, m AS (SELECT 'a' AS member_set, * FROM a UNION ALL SELECT 'b', * FROM b)
        SELECT member_set, count(*) AS members, count(*) FILTER ((entity_type, entity_id) IN (SELECT (entity_type, entity_id) FROM l)) AS in_universe FROM m GROUP BY member_set""",
    "alignment_rows": f"WITH {_A}, {_B}, {_LATE}" + """, m AS (SELECT 'a' AS member_set, * FROM a UNION ALL SELECT 'b', * FROM b)
        SELECT *, (entity_type, entity_id) IN (SELECT (entity_type, entity_id) FROM l) AS in_universe FROM m""",
    "strict_membership": f"SELECT DISTINCT entity_type, entity_id FROM ({_LINKS}) JOIN ({_DOCS}) USING (project, document_id) WHERE project = 'F'",
    "text_overlap": """WITH u AS (SELECT DISTINCT lang AS entity_type, doc_id AS entity_id FROM documents), j AS (SELECT * FROM documents JOIN labels USING (doc_id)),
        c AS (SELECT CASE WHEN x AND y THEN 'both' WHEN x THEN 'a_only' WHEN y THEN 'b_only' ELSE 'neither' END AS overlap_category FROM (
        SELECT (entity_type, entity_id) IN (SELECT (lang, doc_id) FROM j WHERE quality = 1) AS x, (entity_type, entity_id) IN (SELECT (lang, doc_id) FROM j WHERE toxic = 0 AND n_chars > 200) AS y FROM u))"""
    + _SUMMARY.format("c"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query functions by name."""
    own = {name: f for name, f in globals().items() if name in _SQL}
    return own | {f"category_{label}": _category(label) for label in LABELS}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return dict(_SQL)
