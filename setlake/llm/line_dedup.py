"""Near-duplicate lines by a deletion-neighbourhood join, with DataFrame functions only.

The edit distance counts words: a line within one inserted, deleted or replaced word of an earlier
line (smaller id, then smaller line number) goes, as does one with the same words; lines are judged
on the input, not on what is left. Lines under ``MIN_WORDS`` words only go if they are the same; lines
without a word always stay.

1. Lines of the same words, by 128 bits of SHA-256, are one from the start: the earliest stands for them.
2. Two lines within one edit share their first or their last half of words, so only lines that share
   such a half with a different line go on; the halves are counted by hash, a few bytes a line.
3. Those emit every variant with one word deleted, as a hashed key. Variants with the gap at the same
   place join lines that differ in one word; the variant of a longer line joins the full line that
   equals it. Keys are sums (exclusive or) of hashes of words with their place or their neighbour, so
   all variants of a line take time in proportion to its words.
4. Lines of a variant are compared to the earliest of them, never to each other: any two differ by
   one edit, so the earliest is what matters. Each comparison is verified word by word.

Defined cases: null and empty texts have no line with a word and stay; a very long text is split whole, and its lines are taken by
number in time that grows with them; of equal lines the earliest stays; rows that share an id or have
none are documents of their own (see ``with_key``); an empty table gives an empty result; columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlake.llm.common import drop_scratch, materialise, numbered_columns, release_shuffles, with_key

#: Shortest line, in words, that may be removed for a line that is not the same.
MIN_WORDS = 5
_SPACE = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _words(line: Column) -> Column:
    """The words of a line; a blank line has the one word ''."""
    return F.split(F.btrim(line, F.lit(_SPACE)), "[ \\t\\x0B\\f\\r]+")


def _halves(words: Column, n: Column) -> Column:
    """Hashes of the first and last ``h`` words for h = n // 2 and (n - 1) // 2."""
    keys = []
    for h in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        keys += [F.xxhash64(F.lit("first"), h, F.slice(words, F.lit(1), h)), F.xxhash64(F.lit("last"), h, F.slice(words, n - h + 1, h))]
    return F.array_distinct(F.array(*keys))


def _variants(rows: DataFrame) -> DataFrame:
    """``rows`` (key, line, words) to (key, line, role, k), one row per variant."""
    zero = F.lit(0).cast("long")
    xor = lambda a: F.aggregate(a, zero, lambda s, x: s.bitwiseXOR(x))
    ends = F.lit("")  # stands before the first and after the last word
    hashed = rows.select("key", "line", F.size("words").alias("n"), F.transform("words", lambda w, i: F.xxhash64(w, i)).alias("placed"), F.concat(F.array(ends), "words", F.array(ends)).alias("framed"))
    # of each word: its link to the word before, the last one also being that of the end
    links = F.transform(F.slice("framed", F.lit(2), F.col("n") + 1), lambda w, i: F.xxhash64(F.get("framed", i), w))
    across = F.transform(F.slice("framed", F.lit(2), F.col("n")), lambda w, i: F.xxhash64(F.get("framed", i), F.get("framed", i + 2)))
    summed = hashed.select("key", "line", "n", "placed", links.alias("links"), across.alias("across"))
    summed = summed.select("*", xor(F.col("placed")).alias("all_placed"), xor(F.col("links")).alias("all_links"))
    gap = F.transform("placed", lambda h, i: F.struct(F.lit(0).alias("role"), F.xxhash64(F.lit("gap"), F.col("n"), i, F.col("all_placed").bitwiseXOR(h)).alias("k")))
    full = F.array(F.struct(F.lit(1).alias("role"), F.xxhash64(F.lit("full"), F.col("n"), F.col("all_links")).alias("k")))
    shorter = F.transform("across", lambda h, i: F.struct(F.lit(2).alias("role"), F.xxhash64(F.lit("full"), F.col("n") - 1, F.col("all_links").bitwiseXOR(h).bitwiseXOR(F.get("links", i)).bitwiseXOR(F.get("links", i + 1))).alias("k")))
    return summed.select("key", "line", F.explode(F.concat(gap, full, shorter)).alias("v")).select("key", "line", "v.role", "v.k")


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are within one edit."""
    na, nb = F.size(a), F.size(b)
    differing = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d))
    long, short = F.when(na > nb, a).otherwise(b), F.when(na > nb, b).otherwise(a)
    n = F.size(short)
    at = F.array_position(F.zip_with(short, F.slice(long, F.lit(1), n), lambda x, y: x == y), F.lit(False)).cast("int")
    at = F.when(at == 0, n + 1).otherwise(at)
    rest = F.when(at > n, F.lit(True)).otherwise(F.slice(long, at + 1, F.lit(1 << 30)) == F.slice(short, at, F.lit(1 << 30)))
    return F.when(na == nb, differing <= 1).when(F.abs(na - nb) == 1, rest).otherwise(False)


def near_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines to remove of documents with a unique ``_key``: rows key, line (from 0)."""
    spark = df.sparkSession
    lines = df.select(F.col("_key").alias("key"), F.posexplode(_lines(F.col(text_col))).alias("line", "text"))
    words = lines.select("key", "line", _words(F.col("text")).alias("words")).filter(F.get("words", F.lit(0)) != "")
    n = F.size("words")
    digest = F.unhex(F.substring(F.sha2(F.array_join("words", " "), 256), 1, 32))
    table = words.select("key", "line", digest.alias("digest"), F.when(n >= MIN_WORDS - 1, _halves(F.col("words"), n)).alias("halves"))
    table = materialise(table, "lines")
    firsts = materialise(table.groupBy("digest").agg(F.min(F.struct("key", "line")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("halves").alias("halves")), "firsts")
    same = table.join(firsts.filter("n > 1").select("digest", "first"), "digest").filter(F.struct("key", "line") != F.col("first")).select("key", "line")

    halves = firsts.select("first.key", "first.line", F.explode("halves").alias("half"))
    shared = materialise(halves.groupBy("half").count().filter("count > 1").select("half"), "halves")
    maybe = halves.join(shared, "half", "left_semi").groupBy("key").agg(F.collect_set("line").alias("wanted"))
    fetched = _split_below(df.select(F.col("_key").alias("key"), text_col), text_col, materialise(maybe, "maybe"), "key", "inner")
    picked = fetched.select("key", F.explode(F.transform("wanted", lambda i: F.struct(i.alias("line"), F.get("_lines", i).alias("text")))).alias("s"))
    texts = materialise(picked.select("key", "s.line", _words(F.col("s.text")).alias("words")), "texts")
    release_shuffles(spark)

    variants = materialise(_variants(texts), "variants")
    place = F.struct("key", "line")
    gaps = variants.filter("role = 0")
    hubs = materialise(gaps.groupBy("k").agg(F.min(place).alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("k", "hub"), "hubs")
    replaced = gaps.join(hubs, "k").filter(place != F.col("hub")).select(place.alias("late"), F.col("hub").alias("early"))
    full = variants.filter("role = 1").select("k", place.alias("a"))
    longer = variants.filter("role = 2").select("k", place.alias("b"))
    inserted = longer.join(full, "k").select(F.greatest("a", "b").alias("late"), F.least("a", "b").alias("early"))
    pairs = materialise(replaced.unionByName(inserted).distinct(), "pairs")
    late = texts.select(place.alias("late"), F.col("words").alias("lw"))
    early = texts.select(place.alias("early"), F.col("words").alias("ew"))
    near = materialise(pairs.join(late, "late"), "late").join(early, "early").filter((F.size("lw") >= MIN_WORDS) & _within_one(F.col("lw"), F.col("ew")))
    gone = materialise(same.unionByName(near.select("late.key", "late.line")).distinct(), "gone")
    drop_scratch(spark, table, variants, texts, pairs)
    release_shuffles(spark)
    return gone


def _split_below(df: DataFrame, text_col: str, other: DataFrame, key: str, how: str) -> DataFrame:
    """``df`` with ``_lines`` instead of its text, joined to ``other``.

    Texts are split below the join: above it, an expression that takes line by line would split the text anew for each.
    """
    return df.withColumn("_lines", F.when(F.col(text_col).isNotNull(), _lines(F.col(text_col)))).drop(text_col).join(other, key, how)


def _kept(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with ``_key``, ``_lines`` instead of its text (null of a null), ``_gone`` (line numbers, or null) and ``_kept`` (the lines that stay)."""
    keyed, _ = with_key(df, id_col, text_col)
    gone = near_lines(keyed, id_col, text_col).groupBy("key").agg(F.collect_list("line").alias("_gone")).select(F.col("key").alias("_key"), "_gone")
    numbers = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.transform(numbers, lambda i: F.get("_lines", i))
    return _split_below(keyed, text_col, gone, "_key", "left").withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(kept))


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_lines, n_removed, kept_sha256 (of the lines that stay, joined by line feeds)."""
    named = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    empty = F.col("_lines").isNull() | ((F.size("_lines") == 1) & (F.get("_lines", F.lit(0)) == ""))
    return _kept(named, "doc_id", "text").select(
        "doc_id",
        F.when(empty, 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed"),
        F.sha2(F.coalesce(F.array_join("_kept", "\n"), F.lit("")), 256).alias("kept_sha256"),
    )


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with its texts cut to the lines that stay; texts that lose nothing are untouched, nulls included."""
    inner, (ident, text) = numbered_columns(df, id_col, text_col)
    return _kept(inner, ident, text).withColumn(text, F.array_join("_kept", "\n")).select(inner.columns).toDF(*df.columns)
