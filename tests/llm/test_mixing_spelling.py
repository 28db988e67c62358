from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from setlake.llm import mixing, spelling


def filled(sizes: dict, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> dict:
    """Targets by dealing the excess anew until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in free}
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= above
    return target


def words_of(text: str | None) -> int:
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def sources_of(rows) -> dict:
    sizes: dict = defaultdict(int)
    for _, text, _, source, *_ in rows:
        sizes[source] += words_of(text)
    return dict(sizes)


def held_to(rows, found) -> None:
    sizes = sources_of(rows)
    target, taken, longest = filled(sizes), defaultdict(int), defaultdict(int)
    wanted = Counter((r[0], words_of(r[1]), sizes[r[3]], round(target[r[3]], 6)) for r in rows)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in found) == wanted
    by = {(sizes[s], round(target[s], 6)): s for s in sizes}
    for r in found:
        source = by[r.source_size, round(r.target, 6)]
        assert 0 <= r.copies <= 2
        taken[source] += r.copies * r.size
        longest[source] = max(longest[source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] + 1


@pytest.mark.parametrize("seed", (1, 3))
def test_a_mix_meets_its_targets(spark, seed):
    rng = random.Random(seed)
    names = [None, "a", "b", "B", "\u00e9", "\U0001f600", "\ufb01", ""][: 3 + seed * 2]
    share = [rng.random() ** 4 + 0.01 for _ in names]
    rows = [(i, "w " * int(rng.paretovariate(1)), "en", rng.choices(names, share)[0], 1) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = mixing.copies(docs.repartition(7)).collect()
    held_to(rows, found)
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.copies(docs.repartition(3)).collect()))


def test_a_mix_of_odd_rows(spark, odd, empty):
    rows = [tuple(r) for r in odd.collect()]
    held_to(rows, mixing.copies(odd).collect())
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert sum(words_of(r.text) for r in mixed.collect()) > 0
    assert mixing.copies(empty).collect() == [] and mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "s"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.copies, r.target) for r in mixing.copies(blank).collect()] == [(0, 0.0)] * 2


def test_the_mix_emits_what_its_counts_say(docs):
    counts = {r.doc_id: r.copies for r in mixing.copies(docs).collect()}
    emitted = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert dict(emitted) == {i: n for i, n in counts.items() if n}


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute(rows, thin: int = 199, min_length: int = 6, min_count: int = 5, ratio: int = 5) -> list[tuple]:
    counts: Counter = Counter()
    for ident, text, *_ in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if thin and h % thin == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w: str) -> str:
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def table(found) -> list[tuple]:
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or -1) for r in found.collect())


@pytest.mark.parametrize("block", [3, 256])
def test_variants_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(block)
    stems = ["".join(rng.choices("ab\u00e9\u00ffc", k=rng.randint(5, 9))) for _ in range(25)]
    words = []
    for _ in range(400):
        w = rng.choice(stems)
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w[:at] + rng.choice("ab\u00e9z") + w[at:], w[:at] + w[at + 1 :], w[:at] + rng.choice("abZ") + w[at + 1 :]])
        words += [w] * rng.choice([1, 5, 6, 30, 160])
    words += ["aaaaaa" + "x" * k for k in range(4) for _ in range(6)] + ["y" * 3000] * 5 + ["y" * 2999 + "z"] * 30
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)] + [(None, "aaaaaax Bbbbbbb"), (7, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for thin in (3, 0) if block == 3 else (199,):
        assert table(spelling.variants(docs, thin=thin)) == brute(rows, thin)


def test_variants_of_odd_rows(odd, empty):
    assert table(spelling.variants(odd, thin=199, min_count=1)) == brute([tuple(r) for r in odd.collect()], min_count=1)
    assert spelling.variants(empty).collect() == []


def test_variants_of_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    from setlake.llm import catalogue

    assert table(catalogue.op13_spelling_variants(spark, sf_dir)) == brute(rows)
