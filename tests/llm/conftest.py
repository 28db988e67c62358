"""Rows that hold every awkward case: nulls, empties, ties, repeated rows, very long texts, clashing names."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(n: int = 60, seed: int = 3) -> list[tuple]:
    """Invented prose with exact copies, near copies, repeated passages and lines."""
    rng = random.Random(seed)
    syllables = ["the", "an", "re", "ti", "on", "er", "ou", "wh", "é", "ñ", "ß"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    words = [word() for _ in range(200)]
    passage = " ".join(rng.choices(words, k=45))
    line = " ".join(rng.choices(words, k=9))
    rows = []
    for i in range(n):
        kind, body = i % 6, [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(rng.randint(1, 4))]
        if kind == 1 and rows:
            body = rng.choice(rows)[1].split("\n")
        elif kind == 2 and rows:
            text = rng.choice(rows)[1].split(" ")
            text[rng.randrange(len(text))] = word()
            body = " ".join(text).split("\n")
        elif kind == 3:
            body.insert(rng.randrange(len(body) + 1), passage)
        elif kind == 4:
            at = line.split(" ")
            at[rng.randrange(len(at))] = word()
            body += [line, " ".join(at), " ".join(at[:-1]), ""]
        rows.append((i, "\n".join(body), rng.choice(["en", "fr", None]), f"src{i % 2}", 1))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


ODD = [
    (None, None, None, None, None), (None, "a text without id", "en", "s", 1), (1, None, None, "s", 0), (2, "", "en", None, 0), (3, "   ", "en", "s", 3), (3, "   ", "en", "s", 3),
    (4, "same text here", "en", "s", 1), (4, "same text here", "en", "s", 1), (4, "other text, same id", "fr", "t", 1), (5, "same text here", None, "s", 1),
    (6, "word " * 30_000, "en", "s", 1), (7, "x" * 20_000, "en", "s", 1), (8, "\n\n\n", "en", "s", 1), (9, "12 !! 34", "en", "s", 1), (-3, "negative id", "en", "s", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward rows, with columns named like internal ones."""
    names = "digest string, _key bigint, kept boolean, bucket int, group_size int"
    return spark.createDataFrame([(*r, "x", 1, True, 2, 3) for r in ODD], f"{DOCS}, {names}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
