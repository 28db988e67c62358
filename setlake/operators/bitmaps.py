"""Overlap by bitmaps: 64 ids a word, no join.

Ids of a type are cut into words of 64 neighbours; a set is one long of bits a word that it touches. Raw occurrences and both memberships go
into one aggregation by (type, word), whose ``bit_or`` is also the distinct: it is combined before the shuffle, so dense ids move
a few bits each, and sparse ones, alone in their words, about what a plain row would. Flags are bits of the same word, categories
their conjunctions, counts their ``bit_count``. All of it stays within code generation, and no key is compared to a key.

Keys are a string and a long. A null in either matches nothing: such keys of the universe are kept beside the words, in neither set; members with one
count for nothing. Ids may have any sign.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlake.functions import predicates as P
from setlake.operators.sets import distinct_keys
from setlake.schemas import KEY

#: Bits of a word, as a power of two.
_POWER = 6
_SETS = ("u", "a", "b")


def _bit(ident: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), ident.bitwiseAND((1 << _POWER) - 1).cast("int"))


def _words(rows: DataFrame, name: str, key: tuple[str, ...]) -> DataFrame:
    """One row per occurrence with its bit in the column of its set."""
    kind, ident = (F.col(c) for c in key)
    known = rows.filter(kind.isNotNull() & ident.isNotNull())
    return known.select(kind.alias("kind"), F.shiftright(ident.cast("bigint"), _POWER).alias("word"), *[(_bit(ident.cast("bigint")) if s == name else F.lit(0).cast("bigint")).alias(s) for s in _SETS])


def membership_words(occurrences: DataFrame, a: DataFrame, b: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Rows kind, word, u, a, b: the bits of the universe and of both sets, for words that the universe touches. One exchange."""
    parts = [_words(rows, name, key) for name, rows in zip(_SETS, (occurrences, a, b), strict=True)]
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "word").agg(*[F.bit_or(s).alias(s) for s in _SETS]).filter("u <> 0")


def _categories(labels: tuple[str, ...]) -> dict[str, Column]:
    """The bits of each category, in the order neither, first only, second only, both."""
    u, a, b = (F.col(s) for s in _SETS)
    neither, a_only, b_only, both = labels
    return {neither: u.bitwiseAND(F.bitwise_not(a.bitwiseOR(b))), a_only: u.bitwiseAND(a).bitwiseAND(F.bitwise_not(b)), b_only: u.bitwiseAND(b).bitwiseAND(F.bitwise_not(a)), both: u.bitwiseAND(a).bitwiseAND(b)}


def _without_key(occurrences: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Distinct keys of the universe with a null."""
    return distinct_keys(occurrences.filter(F.col(key[0]).isNull() | F.col(key[1]).isNull()), key)


def classified(occurrences: DataFrame, a: DataFrame, b: DataFrame, names: tuple[str, str] = ("website", "wikidata"), labels: tuple[str, ...] = P.CATEGORIES, key: tuple[str, ...] = KEY) -> DataFrame:
    """Distinct keys of ``occurrences`` with a flag per set and their category: the rows of :func:`setlake.operators.overlap.classified`."""
    words = membership_words(occurrences, a, b, key)
    on = lambda bits, i: F.call_function("shiftrightunsigned", bits, i).bitwiseAND(1) == 1
    places = F.filter(F.sequence(F.lit(0), F.lit((1 << _POWER) - 1)), lambda i: on(F.col("u"), i))
    rows = words.select("kind", "word", "a", "b", F.explode(places).alias("i"))
    ident = (F.shiftleft("word", _POWER) + F.col("i")).alias(key[1])
    flagged = rows.select(F.col("kind").alias(key[0]), ident, on(F.col("a"), F.col("i")).alias(names[0]), on(F.col("b"), F.col("i")).alias(names[1]))
    odd = _without_key(occurrences, key).select(F.col(key[0]), F.col(key[1]).cast("bigint").alias(key[1]), F.lit(False).alias(names[0]), F.lit(False).alias(names[1]))
    return flagged.unionByName(odd).withColumn("overlap_category", P.category(F.col(names[0]), F.col(names[1]), labels))


def counts_by_type(occurrences: DataFrame, a: DataFrame, b: DataFrame, labels: tuple[str, ...] = P.CATEGORIES, key: tuple[str, ...] = KEY) -> DataFrame:
    """Rows type, one column of keys per category: bits counted, never laid out as rows."""
    words = membership_words(occurrences, a, b, key)
    counted = words.select("kind", *[F.bit_count(bits).cast("bigint").alias(f"n{i}") for i, bits in enumerate(_categories(labels).values())])
    odd = _without_key(occurrences, key).select(F.col(key[0]).alias("kind"), F.lit(1).cast("bigint").alias("n0"), *[F.lit(0).cast("bigint").alias(f"n{i}") for i in (1, 2, 3)])
    return counted.unionByName(odd).groupBy(F.col("kind").alias(key[0])).agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(4)])


def by_type(occurrences: DataFrame, a: DataFrame, b: DataFrame, labels: tuple[str, ...] = P.CATEGORIES, key: tuple[str, ...] = KEY) -> DataFrame:
    """Rows type, category, count; categories without a key have no row."""
    lines = F.array(*[F.struct(F.lit(label).alias("overlap_category"), F.col(f"n{i}").alias("count")) for i, label in enumerate(labels)])
    return counts_by_type(occurrences, a, b, labels, key).select(F.col(key[0]), F.inline(lines)).filter("count > 0")


def summary(occurrences: DataFrame, a: DataFrame, b: DataFrame, labels: tuple[str, ...] = P.CATEGORIES, key: tuple[str, ...] = KEY) -> DataFrame:
    """One row per category in the order of ``labels``: count and percentage, zeros for an empty universe."""
    words = membership_words(occurrences, a, b, key)
    counted = words.select(*[F.bit_count(bits).cast("bigint").alias(f"n{i}") for i, bits in enumerate(_categories(labels).values())])
    odd = _without_key(occurrences, key).select(F.lit(1).cast("bigint").alias("n0"), *[F.lit(0).cast("bigint").alias(f"n{i}") for i in (1, 2, 3)])
    totals = counted.unionByName(odd).agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(4)])
    total = F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3")
    share = lambda n: F.when(total > 0, n / total * F.lit(100.0)).otherwise(F.lit(0.0))
    lines = [F.struct(F.lit(label).alias("overlap_category"), F.col(f"n{i}").alias("count"), share(F.col(f"n{i}")).cast("double").alias("percentage")) for i, label in enumerate(labels)]
    return totals.select(F.inline(F.array(*lines)))
