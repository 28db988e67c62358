"""Mixing sources to target weights by systematic sampling.

Every source has a target, a share of the words of all sources by its weight, capped at a number of times of its own words. A
document's expected copies are its source's target over the source's words. Within a source, documents sorted by size stand one behind
the other on a line, each as long as its expected copies; one random offset shifts the line, and a document is emitted once for
each integer boundary that it crosses. So no document exceeds its expected copies rounded up, and, as neighbours on the line are about as
long, a source's words miss its target by no more than its longest document.

The prefix sums are exact decimals and come from :func:`running_sums`, so no task holds a source. The offset of a source is a hash of its name and
the seed: reruns agree, however the rows are dealt. Defined cases: a null text has size 0 and crosses boundaries like any other; a null
source is one of its own, behind all others; sources without a word have target 0 and give no copy; rows sharing an id are
documents of their own; equal rows differ in their copies by one at most; very long texts count whole; an empty table gives an empty result. :func:`mix`
keeps columns of any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlake.llm.common import materialise, numbered_columns, running_sums, with_key

#: What counts as a word.
WORD = r"[^\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    """Words of a whole text; none of a null."""
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``sources`` (none, source, source_size) with their target.

    Weights repeat in order of the names. Targets are ``share`` of all words dealt by weight; those above ``cap`` times their source's words stop
    there and their excess is dealt anew. In order of cap over weight, those that stop are a prefix: what is left behind each one over the
    weights left is the level that the next ones would get.
    """
    ordered = running_sums(sources.withColumn("one", F.lit(1)), [], [F.col("none").asc(), F.col("source").asc()], ["one"], "weighed")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    weighed = ordered.select("none", "source", "source_size", turn.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("most"))
    line = running_sums(weighed, [], [(F.col("most") / F.col("weight")).asc(), F.col("none").asc(), F.col("source").asc()], ["most", "weight"], "levels")
    dealt, all_weights = sources.agg(F.sum("source_size") * F.lit(float(share))).scalar(), weighed.agg(F.sum("weight")).scalar()
    levels = line.withColumn("level", (dealt - F.col("before_most")) / (all_weights - F.col("before_weight")))
    level = levels.filter(F.col("most") >= F.col("level") * F.col("weight")).agg(F.min_by("level", F.col("most") / F.col("weight"))).scalar()
    return weighed.select("none", "source", "source_size", F.least("most", F.coalesce(level * F.col("weight"), F.col("most"))).alias("target"))


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    source = F.col(source_col).cast("string")
    return df.select(F.col(id_col).alias("doc_id"), source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("source"), size(F.col(text_col)).alias("size"))


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 12) -> DataFrame:
    """One row per row of ``df``: doc_id, size, source_size, target, copies."""
    sized = materialise(_sized(df, id_col, text_col, source_col), "sized")
    sources = materialise(sized.groupBy("none", "source").agg(F.sum("size").alias("source_size")), "sources")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0).cast("decimal(19,18)")
    known = materialise(targets(sources, weights, share, cap).withColumn("expected", expected), "targets")
    line = running_sums(sized.join(known, ["none", "source"]), ["none", "source"], [F.col("size").asc(), F.col("doc_id").asc_nulls_first()], ["expected"], "line")
    offset = F.pmod(F.xxhash64(F.lit(seed), "none", "source"), F.lit(10**9)).cast("decimal(9,0)") * F.lit(Decimal("0.000000001"))
    start = F.col("before_expected").cast("decimal(33,18)") + offset
    crossed = (F.floor(start + F.col("expected")) - F.floor(start)).cast("long")
    return line.select("doc_id", "size", "source_size", "target", crossed.alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken. ``settings`` are those of :func:`copies`."""
    plain, (ident, text, source) = numbered_columns(df, id_col, text_col, source_col)
    keyed, _ = with_key(plain, ident, text)
    taken = copies(keyed, "_key", text, source, **settings).filter("copies > 0").select(F.col("doc_id").alias("_key"), F.sequence(F.lit(1), F.col("copies").cast("int")).alias("_times"))
    rows = keyed.join(taken, "_key").select(*plain.columns, F.explode("_times").alias("_copy")).drop("_copy")
    return rows.toDF(*df.columns)
