"""Universe, membership flags, categories and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlake.functions import predicates as P
from setlake.operators.sets import distinct_keys
from setlake.schemas import KEY


class OverlapError(RuntimeError):
    """Overlap inputs or outputs break the contract."""


def universe(*occurrences: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """The distinct keys of all occurrences. Deduplicated before any join, so joins see each key once."""
    rows = occurrences[0]
    for more in occurrences[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return distinct_keys(rows, key)


def flagged(keys: DataFrame, a: DataFrame, b: DataFrame, names: tuple[str, str] = ("website", "wikidata"), key: tuple[str, ...] = KEY) -> DataFrame:
    """``keys`` with a boolean per set. Null keys match nothing. AQE broadcasts a set only if it measures small."""
    out = keys
    for name, members in zip(names, (a, b), strict=True):
        marked = distinct_keys(members, key).withColumn(name, F.lit(True))
        out = out.join(marked, list(key), "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return out


def classified(keys: DataFrame, a: DataFrame, b: DataFrame, names: tuple[str, str] = ("website", "wikidata"), labels: tuple[str, str, str, str] = P.CATEGORIES, key: tuple[str, ...] = KEY) -> DataFrame:
    """:func:`flagged` with the overlap category."""
    return flagged(keys, a, b, names, key).withColumn("overlap_category", P.category(F.col(names[0]), F.col(names[1]), labels))


def summary(rows: DataFrame, labels: tuple[str, ...] = P.CATEGORIES) -> DataFrame:
    """One row per category in the order of ``labels``: count and percentage (count / total * 100, 0 for an empty universe). An unknown category fails the query.

    One aggregate, of a row a task; its one row is then laid out as rows, in order.
    """
    label = F.col("overlap_category")
    odd = F.min(F.when(~F.coalesce(label.isin(*labels), F.lit(False)), F.coalesce(label, F.lit("null"))))
    counted = rows.agg(*[F.count_if(label == name).alias(f"n{i}") for i, name in enumerate(labels)], F.count(F.lit(1)).alias("total"), odd.alias("odd"))
    checked = counted.select("*", F.when(F.col("odd").isNotNull(), F.raise_error(F.concat(F.lit("unknown overlap category: "), F.col("odd"))).cast("bigint")).otherwise(F.col("total")).alias("all"))
    share = lambda n: F.when(F.col("all") > 0, n / F.col("all") * F.lit(100.0)).otherwise(F.lit(0.0))
    lines = [F.struct(F.lit(name).alias("overlap_category"), F.col(f"n{i}").cast("bigint").alias("count"), share(F.col(f"n{i}")).cast("double").alias("percentage")) for i, name in enumerate(labels)]
    return checked.select(F.inline(F.array(*lines)))


def occurrence_counts(rows: DataFrame, by: str = "osm_type", key: tuple[str, ...] = KEY) -> DataFrame:
    """Occurrences and distinct keys per type."""
    per_key = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(by).agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("identities"))


def orphans(members: DataFrame, keys: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Members that are not in the universe; they are never classified."""
    return distinct_keys(members, key).join(keys, list(key), "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Keys of both inventories."""
    return distinct_keys(a, key).join(b.select(*key), list(key), "left_semi")


def sharded(rows: DataFrame, shards: int = 64) -> DataFrame:
    """Rows dealt to ``shards`` partitions by key and sorted within; the last wide step of a plan."""
    placed = rows.withColumn("_shard", P.shard(F.col("osm_type"), F.col("osm_id"), shards))
    return placed.repartitionById(shards, F.col("_shard")).sortWithinPartitions("osm_type", "osm_id").drop("_shard")
