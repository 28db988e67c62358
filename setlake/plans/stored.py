"""Overlap over stored tables: universe, memberships and result are manifest tables, bucketed by key.

Each input is shuffled once, when it is stored. After that the universe is made distinct, joined to both memberships and written without an
exchange, bucket by bucket, by as many tasks as there are buckets. Buckets are a power of two times the shards, so the shard of a key is
its bucket's number modulo the shards whatever the size of the table, and a shard has as many files as its data asks for. Counts are
observed while rows are written. Any store that Spark reaches will do; nothing is renamed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlake.functions import predicates as P
from setlake.operators import overlap as O  # noqa: E741
from setlake.operators.sets import distinct_keys
from setlake.schemas import KEY
from setlake.sinks.manifest import Buckets, ManifestTable, Version, bucketed

SHARDS = 64
#: Keys that a bucket is meant to hold.
BUCKET_ROWS = 4_000_000


def buckets_for(rows: int) -> Buckets:
    """Buckets for about so many keys: the shards, or twice as many until a bucket holds its due."""
    number = SHARDS
    while number * BUCKET_ROWS < rows:
        number *= 2
    return Buckets(number, KEY)


def shard_of(number: int = SHARDS) -> Column:
    """The shard of a key: its bucket's number modulo the shards, as Spark deals buckets."""
    return F.pmod(F.hash(*KEY), F.lit(number)).cast("int")


def store_keys(table: ManifestTable, rows: DataFrame, buckets: Buckets, facts: dict | None = None) -> Version:
    """Store the distinct keys of ``rows``: one exchange, then distinct within each bucket."""
    return table.write(distinct_keys(bucketed(rows.select(*KEY), buckets)), buckets=buckets, facts=facts)


@dataclass(frozen=True, slots=True)
class StoredOverlap:
    version: Version
    summary: dict[str, int]


def _classified(universe: DataFrame, website: DataFrame, wikidata: DataFrame) -> DataFrame:
    return O.classified(distinct_keys(universe), website, wikidata)


def compute_stored_overlap(universe: ManifestTable, website: ManifestTable, wikidata: ManifestTable, output: ManifestTable) -> StoredOverlap:
    """Classify the stored universe and publish the result, unless its latest version is of the same inputs already.

    Inputs of one number of buckets are joined without an exchange; of different numbers Spark deals out the smaller ones anew.
    """
    inputs = {name: t.latest() for name, t in (("universe", universe), ("website", website), ("wikidata", wikidata))}
    if missing := [name for name, v in inputs.items() if v is None]:
        raise O.OverlapError(f"nothing is published as {', '.join(missing)}")
    facts = {"inputs": {name: [t.store.root, v.folder] for (name, v), t in zip(inputs.items(), (universe, website, wikidata), strict=True)}, "shards": SHARDS}
    last = output.latest()
    if last is None or last.facts != facts:
        rows = _classified(*(t.read(v) for t, v in zip((universe, website, wikidata), inputs.values(), strict=True)))
        label = F.col("overlap_category")
        last = output.write(rows, buckets=inputs["universe"].buckets, metrics={c: F.count_if(label == c) for c in P.CATEGORIES}, facts=facts)
    return StoredOverlap(last, {c: last.metrics[c] for c in P.CATEGORIES})


def shard_files(version: Version) -> dict[int, list[str]]:
    """Files of each shard by the bucket numbers in their names."""
    out: dict[int, list[str]] = {}
    for name, _ in version.files:
        bucket = int(name.rsplit("_", 1)[1].split(".")[0])
        out.setdefault(bucket % version.facts["shards"], []).append(name)
    return out


def summary_frame(spark: SparkSession, found: StoredOverlap) -> DataFrame:
    """The four-row summary from the observed counts."""
    total = sum(found.summary.values())
    rows = [(c, n, n / total * 100.0 if total else 0.0) for c, n in found.summary.items()]
    return spark.createDataFrame(rows, "overlap_category string, count bigint, percentage double")
