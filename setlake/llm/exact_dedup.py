"""Exact deduplication by two-pass Bloom filtering, with DataFrame functions only.

Pass 1 counts, for every row's digest, two positions of a blocked Bloom filter; positions hit at
least twice become the filter. The counts are aggregated by position, so what moves is a few bytes a
row and never a whole bitmap from each task. Pass 2 looks every digest up in the filter: rows whose
positions are not both set are certainly alone and pass straight through without a shuffle; only the
others are grouped by their SHA-256.

The filter has 16 bits a row, at most :data:`MAX_BITS` (32 MB), which bounds what is broadcast. Beyond
that its false positives rise, so more rows are grouped exactly; no result changes.

Defined cases: a null text counts as empty; very long texts are digested whole; a null id sorts below every id; of rows
repeated in every column exactly one stays; an empty table gives an empty result; extra columns pass through whatever
their names and types, maps included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlake.llm.common import materialise, numbered_columns

#: Bits of one filter block, the size of Spark's bitmap aggregates.
BLOCK = 32768
#: Upper bound of the filter: 2**28 bits are 32 MB.
MAX_BITS = 1 << 28


def filter_bits(rows: int) -> int:
    """Filter size for ``rows`` digests: 16 bits a row as a power of two, within one block and MAX_BITS."""
    return min(MAX_BITS, max(BLOCK, 1 << max(0, 16 * rows - 1).bit_length()))


def _positions(digest: Column, bits: int) -> tuple[Column, Column, Column]:
    block = F.pmod(F.xxhash64(digest), F.lit(bits // BLOCK)).cast("int")
    return block, F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(BLOCK)).cast("int"), F.pmod(F.xxhash64(digest, F.lit(2)), F.lit(BLOCK)).cast("int")


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte.cast("long"), bit % 8) == 1


def repeat_filter(digests: DataFrame, bits: int) -> DataFrame:
    """Pass 1 over a column ``digest``: rows (``_block``, ``_bitmap``) of positions that at least two entries hit."""
    block, one, two = _positions(F.col("digest"), bits)
    hits = digests.select(block.alias("_block"), F.explode(F.array_distinct(F.array(one, two))).alias("_bit"))
    twice = hits.groupBy("_block", "_bit").count().filter("count > 1")
    return twice.groupBy("_block").agg(F.bitmap_construct_agg(F.col("_bit").cast("long")).alias("_bitmap"))


def flag_repeats(df: DataFrame, filter_rows: DataFrame, bits: int) -> DataFrame:
    """Pass 2: ``df`` (with ``digest``) plus ``_maybe``, false only for digests that occur once."""
    block, one, two = _positions(F.col("digest"), bits)
    joined = df.withColumn("_block", block).join(F.broadcast(filter_rows), "_block", "left")
    maybe = F.col("_bitmap").isNotNull() & _is_set(F.col("_bitmap"), one) & _is_set(F.col("_bitmap"), two)
    return joined.withColumn("_maybe", F.coalesce(maybe, F.lit(False))).drop("_block", "_bitmap")


def text_digest(text: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    """SHA-256 of a text (null: empty) after ``normalise``, as 32 bytes."""
    text = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(normalise(text) if normalise else text, 256))


def _rest(df: DataFrame) -> Column:
    """A hash of all columns, which tells rows equal in id and text apart. Maps, which have no hash, count by their JSON."""
    return F.xxhash64(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema])


def _plan(digests: DataFrame) -> tuple[DataFrame, int, DataFrame]:
    """The filter, its size, and one row per repeated digest: winner and group size."""
    bits = filter_bits(digests.count())
    filter_rows = materialise(repeat_filter(digests, bits), "bloom")
    maybe = flag_repeats(digests, filter_rows, bits).filter("_maybe").drop("_maybe")
    each = maybe.groupBy("digest", "id", "_rest").agg(F.count(F.lit(1)).alias("n"), F.max("_row").alias("_row"))
    groups = each.groupBy("digest").agg(F.max(F.struct("id", "_rest", "_row", "n")).alias("_win"), F.sum("n").alias("group_size"))
    # written, so that both sides of the joins with it are plain exchanges, whose hot keys AQE can split
    return filter_rows, bits, materialise(groups, "groups")


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the largest id stays."""
    digests = materialise(
        df.select(F.col(id_col).alias("id"), text_digest(F.col(text_col), normalise).alias("digest"), F.lit(0).alias("_rest"), F.monotonically_increasing_id().alias("_row")), "digests"
    )
    filter_rows, bits, groups = _plan(digests)
    flagged = flag_repeats(digests, filter_rows, bits)
    out = lambda keep, size, kept: [F.col("id").alias("doc_id"), keep.alias("keep_id"), size.cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    alone = flagged.filter("NOT _maybe").select(out(F.col("id"), F.lit(1), F.lit(True)))
    grouped = flagged.filter("_maybe").join(groups, "digest").select(out(F.col("_win.id"), F.col("group_size"), F.col("_row") == F.col("_win._row")))
    return alone.unionByName(grouped)


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """``df`` without the rows whose text another row with a larger id has; columns as given.

    Rows that the filter clears are never shuffled. Rows equal in id and text are told apart by all
    their columns; of fully repeated rows one stays.
    """
    inner, (ident, text) = numbered_columns(df, id_col, text_col)
    rows = inner.withColumn("digest", text_digest(F.col(text), normalise)).withColumn("_rest", _rest(inner))
    digests = materialise(rows.select(F.col(ident).alias("id"), "digest", "_rest", F.monotonically_increasing_id().alias("_row")), "digests")
    filter_rows, bits, groups = _plan(digests)
    flagged = flag_repeats(rows, filter_rows, bits)
    won = flagged.filter("_maybe").join(groups, "digest").filter(F.col(ident).eqNullSafe(F.col("_win.id")) & (F.col("_rest") == F.col("_win._rest")))
    single = won.filter("_win.n = 1").select(inner.columns)
    repeated = won.filter("_win.n > 1").dropDuplicates(["digest"]).select(inner.columns)
    return flagged.filter("NOT _maybe").select(inner.columns).unionByName(single).unionByName(repeated).toDF(*df.columns)
