from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from setlake.llm import collocations, mph


@pytest.mark.parametrize("n", [0, 1, 2, 70, 20_000])
def test_a_perfect_hash_is_minimal_and_verifies(n):
    rng = np.random.default_rng(n)
    keys = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
    for n_shards, rounds, own in ((1, 1, 0), (7, 1, 0), (3, 2, 1)):
        mine = keys[mph.spread(keys) % rounds == own]
        shard = mph.spread(mine) // rounds % n_shards
        table = mph.PerfectHash({s: mph.build(mine[shard == s]) for s in range(n_shards) if (shard == s).any()}, n_shards, rounds, own)
        slots = table.slots(mine)
        assert len(table) == len(mine) and sorted(slots.tolist()) == list(range(len(mine)))
        assert (table.keys[slots] == mine).all()
        others = np.setdiff1d(rng.choice(1 << 41, 5000).astype(np.uint64), mine)
        assert (table.slots(others) == -1).all()


def brute(rows, longest: int = 5, least: int = 100, absorb: int = 100, top: int = 2000) -> list[tuple]:
    total, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        held = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for q, m in held.items():
            for k in range(2, len(q)):
                gone |= {p for i in range(len(q) - k + 1) if (p := q[i : i + k]) in held and 100 * m >= absorb * held[p]}
        kept = []
        for p, a in held.items():
            if p not in gone:
                score, _, left, right = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, total[lang], -score) for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def table(found) -> list[tuple]:
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in found.collect())


def prose(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["to", "be", "or", "not", "été", "Straße", "x", " ", " ", "\x00", "\x1c", "𝒳", "ÿ", "\x7f"]
    idioms = [["to", "be", "or", "not"], ["a", "a", "a", "a", "a", "a"], ["new", "york", "city", "hall", "x"]]
    rows = []
    for _ in range(120):
        text = ""
        for _ in range(rng.randint(0, 25)):
            text += " ".join(rng.choice(idioms) if rng.random() < 0.4 else rng.choices(words, k=rng.randint(1, 3)))
            text += rng.choice([" ", "  ", "\t", "\n", "\r\n", ". ", ",", " ; ", "\x0b", ":", "!?", "\x0c"])
        rows.append((rng.choice([text, text.upper()]), rng.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_brute_force(spark, monkeypatch, small):
    if small:  # several rounds of words and candidates, crowded counters, many shards
        for name, size in (("SLOTS", 2048), ("CANDIDATES", 60), ("WORDS", 20), ("SHARD", 8)):
            monkeypatch.setattr(collocations, name, size)
    rows = prose(int(small))
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    settings = {"least": 3, "longest": 4} if small else {"least": 6, "absorb": 80, "top": 40}
    assert table(collocations.top_phrases(docs, **settings)) == brute(rows, **settings)


def test_phrases_of_odd_rows(odd, empty):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    assert table(collocations.top_phrases(odd, least=2)) == brute(rows, least=2)
    assert collocations.top_phrases(empty).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.createDataFrame([(big, 10 * big, big, big + 1)], "a long, total long, l long, r long").select(collocations._score("a", "total", F.col("l"), F.col("r")).alias("s")).first()
    assert row.s == 1000 * big * 10 * big // (big * (big + 1))
