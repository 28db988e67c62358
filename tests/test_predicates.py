from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from setlake.functions import predicates as P
from setlake.functions.predicates import Flags, Identity

SEPARATORS = [0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]


def test_category_column_and_python_agree(spark):
    rows = [(a, b) for a in (False, True) for b in (False, True)]
    got = spark.createDataFrame(rows, "a boolean, b boolean").select("a", "b", P.category(F.col("a"), F.col("b")).alias("c")).collect()
    assert {(r.a, r.b): r.c for r in got} == {(a, b): Flags(a, b).category for a, b in rows}
    assert [Flags(*x).category for x in ((0, 0), (1, 0), (0, 1), (1, 1))] == list(P.CATEGORIES)


@pytest.mark.parametrize("kind,ident", [("node", 1), ("way", 0), ("relation", -1)])
def test_identity_rejects(kind, ident):
    with pytest.raises(ValueError):
        Identity(kind, ident)


def test_identity_key():
    assert Identity("way", 3).key == ("way", 3)


def test_text_present_strips_unicode_separators_only(spark):
    blank = [None, "", *(chr(c) * 2 for c in SEPARATORS)]
    present = ["\t", "\n", "​", "﻿", " x ", "　x"]
    rows = spark.createDataFrame([(x,) for x in blank + present], "t string").select(P.text_present(F.col("t")).alias("p")).collect()
    assert [r.p for r in rows] == [False] * len(blank) + [True] * len(present)


@pytest.mark.parametrize("refs,first3,distinct3", [
    ([1, 2, 3, 1], True, True), ([1, 2, 3, 4, 1], True, True), ([1, 2, 3], False, False), ([1, 2, 1], False, False),
    ([1, 2, 3, 2], False, False), ([1, 2, 2, 1], False, False), ([1, 2, 1, 3, 4, 1], False, True), ([1, 2, 2, 3, 1], False, True), ([], False, False), (None, False, False),
])
def test_ring_rules(spark, refs, first3, distinct3):
    row = spark.createDataFrame([(refs,)], "r array<bigint>").select(*[P.closed_ring(F.col("r"), x).alias(x) for x in P.RING_RULES]).first()
    assert (row.first3, row.distinct3) == (first3, distinct3)


def test_unknown_ring_rule():
    with pytest.raises(ValueError):
        P.closed_ring(F.lit(None), "other")


def test_shard_is_stable_and_in_range(spark):
    got = spark.range(1, 1000).select(P.shard(F.lit("way"), F.col("id"), 64).alias("s")).distinct().collect()
    assert {r.s for r in got} == set(range(64))
