"""Exact, near, line and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from setlake.llm import exact_dedup, line_dedup, simhash, substring_dedup
from setlake.llm.components import components
from tests.llm.conftest import DOCS

sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_filter_size_is_bounded():
    assert [exact_dedup.filter_bits(n) for n in (0, 1, 3000, 10**12)] == [1 << 15, 1 << 15, 1 << 16, 1 << 28]


def test_exact_groups(spark, docs, rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r[0])
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.duplicate_groups(docs).collect()}
    assert got == {r[0]: (max(by[r[1]]), len(by[r[1]]), r[0] == max(by[r[1]]), sha(r[1])) for r in rows} and any(v[1] > 1 for v in got.values())


def test_exact_filter_clears_most_rows_and_no_repeat(spark, rows):
    digests = spark.createDataFrame([(hashlib.sha256(str(i // 2 if i < 10 else i).encode()).digest(),) for i in range(2000)], "digest binary")
    bits = exact_dedup.filter_bits(2000)
    flagged = exact_dedup.flag_repeats(digests, exact_dedup.repeat_filter(digests, bits), bits).collect()
    repeats = {hashlib.sha256(str(i).encode()).digest() for i in range(5)}
    assert all(r._maybe for r in flagged if bytes(r.digest) in repeats) and sum(r._maybe for r in flagged) < 150


def test_exact_plan_is_native(docs):
    plan = exact_dedup.duplicate_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_odd_rows(odd, empty):
    got = exact_dedup.duplicate_groups(odd).collect()
    assert len(got) == 15
    kept = [r for r in got if r.text_sha256 == sha("same text here") and r.kept]
    assert len(kept) == 1 and kept[0].doc_id == 5 and kept[0].group_size == 3
    blank = [r for r in got if r.text_sha256 == sha("")]
    assert {r.keep_id for r in blank} == {2} and len(blank) == 3
    assert sum(r.kept for r in got if r.text_sha256 == sha("   ")) == 1
    rows = exact_dedup.drop_exact_duplicates(odd)
    assert rows.columns == odd.columns and rows.count() == len({r.text_sha256 for r in got})
    assert exact_dedup.duplicate_groups(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_exact_normalised(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "A b"), (2, "a B")], "doc_id int, text string")
    assert [r.doc_id for r in exact_dedup.drop_exact_duplicates(df, normalise=F.lower).collect()] == [2]


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 52), (7, 7)], [(i, (i * 7 + 3) % 60) for i in range(60)]])
def test_components(spark, links):
    parent = {x: x for pair in links for x in pair if pair[0] != pair[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_duplicates, simhash.drop_near_duplicates, line_dedup.drop_repeated_lines, substring_dedup.drop_repeats])
def test_columns_with_internal_names_pass_through(odd, drop):
    assert {(r.digest, r._key, r.kept, r.bucket, r.group_size) for r in drop(odd).collect()} == {("x", 1, True, 2, 3)}


def naive_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_groups(prints, radius=3):
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


def test_fingerprint():
    for text in ("", "one", "One tWO", "a b c d e f g", "É é É É", "x " * 70_000):
        assert simhash.fingerprint(text.encode()) == (naive_fingerprint(text) if len(text) < 1000 else naive_fingerprint("x x x"))


def test_masks_cover_every_set_of_positions():
    masks = simhash.covering_masks(3)
    assert len(masks) == 15 and all(28 <= m.bit_count() <= 40 for m in masks)
    rng = np.random.default_rng(1)
    for _ in range(5000):
        spots = rng.choice(64, 3, replace=False)
        assert any(not any(m >> int(s) & 1 for s in spots) for m in masks)


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_near_links_by_both_ways(spark, bucket_rows):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    prints = sorted({int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for c in centres for _ in range(25)})
    nodes = spark.createDataFrame([(simhash._signed(p), i) for i, p in enumerate(prints)], "fp long, node long")
    found = {r.node: r.component for r in components(simhash.near_links(nodes, 3, bucket_rows)).collect()}
    assert [found.get(i, i) for i in range(len(prints))] == naive_groups(prints)


def test_near_groups(spark, docs, rows):
    prints = [naive_fingerprint(r[1]) for r in rows]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_groups(docs).collect()}
    assert got == {i: (f"{p:016x}", g) for i, (p, g) in enumerate(zip(prints, naive_groups(prints), strict=True))}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == {g for _, g in got.values()}


def test_near_odd_rows(odd, empty):
    got = simhash.near_groups(odd).collect()
    assert len(got) == 15 and sum(r.fingerprint == "0" * 16 for r in got) == 6  # two nulls and four blank texts
    assert simhash.drop_near_duplicates(odd).columns == odd.columns
    assert simhash.near_groups(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def naive_lines(rows):
    def near(a, b):
        if a == b:
            return True
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        long, short = sorted((a, b), key=len, reverse=True)
        return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    seen, out = [], {}
    for i, text, *_ in sorted(rows):
        kept, lines = [], (text or "").split("\n")
        for line in lines:
            words = line.split()
            late = bool(words) and any(words == s or len(words) >= line_dedup.MIN_WORDS and near(words, s) for s in seen)
            if words:
                seen.append(words)
            kept += [] if late else [line]
        out[i] = (len(lines) if text else 0, len(lines) - len(kept), sha("\n".join(kept)))
    return out


def test_lines(docs, rows):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup.repeated_lines(docs).collect()}
    assert got == naive_lines(rows) and sum(v[1] for v in got.values()) > 20


def test_lines_of_one_edit(spark):
    base = "a b c d e f"
    texts = [base, "a b c x e f", "b c d e f", "a b c d e f g", "a b d c e f", "a b c d", "b a", "b c", "a b c d e f  ", "q a b c d e f g"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r.doc_id for r in line_dedup.repeated_lines(df).filter("n_removed = 1").collect()} == {1, 2, 3, 8, 9}


def test_lines_odd_rows(odd, empty):
    assert line_dedup.repeated_lines(odd).count() == 15
    cleaned = line_dedup.drop_repeated_lines(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == 15
    assert sum(r.text is None for r in cleaned.collect()) == 2
    assert line_dedup.repeated_lines(empty).count() == 0
    assert not re.search("Python|Pandas|Arrow", line_dedup.repeated_lines(empty)._jdf.queryExecution().executedPlan().toString())


def naive_windows(rows, size=20):
    seen, out = set(), {}
    for i, text, *_ in sorted(rows):
        words = (text or "").encode().split()
        off = [False] * len(words)
        for s in range(len(words) - size + 1):
            window = tuple(words[s : s + size])
            if window in seen:
                off[s : s + size] = [True] * size
            seen.add(window)
        out[i] = (len(words), sum(off), sha(b" ".join(w for w, x in zip(words, off, strict=True) if not x)))
    return out


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_substrings(docs, rows, batches):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_words(docs, batches).collect()}
    assert got == naive_windows(rows) and sum(v[1] for v in got.values()) > 500


def test_substrings_within_long_texts(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "_SLICE", 64)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in rng.integers(0, 50, 700)]
    words[400:460] = words[100:160]
    texts = [(0, " ".join(words)), (1, "  ".join(words[:300]) + "\t\n" + " ".join(["z"] * 100)), (2, " ".join(words[5:200]))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_words(spark.createDataFrame(texts, "doc_id long, text string"), 2).collect()}
    assert got == naive_windows(texts)


def test_substrings_odd_rows(odd, empty):
    got = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.repeated_words(odd, 2).collect()}
    assert got[6, 30_000] == 30_000 - 1 and len(substring_dedup.repeated_words(odd, 2).collect()) == 15
    cleaned = substring_dedup.drop_repeats(odd, 2)
    assert cleaned.columns == odd.columns and cleaned.count() == 15
    assert substring_dedup.repeated_words(empty).count() == 0


def thue_morse(n: int, flip: bool = False) -> str:
    return "".join("ab"[(i.bit_count() & 1) ^ flip] for i in range(n))


def test_made_up_collisions_remove_nothing(spark):
    """A Thue-Morse word and its complement have equal polynomials modulo 2**64, whatever the base; so have the windows around them."""
    tail = " ".join(f"w{i}" for i in range(19))
    words = [thue_morse(1024), thue_morse(1024, True)]
    grams = [substring_dedup._GRAMS.stretches(np.frombuffer(f"{w} {tail}".encode(), np.uint8)) for w in words]
    assert len({int(g(np.array([0]), np.array([1024 + 1 + len(tail)]))[0]) for g in grams}) == 1
    df = spark.createDataFrame([(i, f"{w} {tail}") for i, w in enumerate(words)] + [(2, f"{words[1]} {tail} x")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.repeated_words(df, 2).collect()} == {0: 0, 1: 0, 2: 20}


def test_index_compacts(spark, docs):
    index = substring_dedup.FingerprintIndex(spark, 3, 2)
    sizes = []
    for part in range(4):
        batch = docs.filter((F.col("doc_id") >= 15 * part) & (F.col("doc_id") < 15 * (part + 1))).select("doc_id", F.col("text").cast("binary"))
        index.add(batch, docs.filter(F.col("doc_id") < 15 * part).select("doc_id", F.col("text").cast("binary")) if part else None)
        sizes.append((len(index.grams.tables), len(index.windows.tables)))
    assert sizes == [(1, 1), (2, 2), (2, 2), (2, 2)]  # the third batch meets one run that was two
    met, _ = index.grams.beside(next(iter(index.grams.tables.values())))
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    index.close()
    assert not index.grams.tables and not spark.sql("SHOW TABLES").filter("tableName LIKE 'run_%'").count()


def test_an_index_lives_from_session_to_session(spark, docs, tmp_path):
    """Three batches, each in a session of its own, give what one session gives; a compaction falls between."""
    batch = lambda part: docs.filter((F.col("doc_id") >= 20 * part) & (F.col("doc_id") < 20 * (part + 1))).select("doc_id", F.col("text").cast("binary"))
    earlier = lambda part: docs.filter(F.col("doc_id") < 20 * part).select("doc_id", F.col("text").cast("binary")) if part else None
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    whole = substring_dedup.FingerprintIndex(spark, 3, 2)
    wanted = [rows(whole.add(batch(k), earlier(k))) for k in range(3)]
    whole.close()
    root = tmp_path.as_uri()
    with pytest.raises(FileNotFoundError):
        substring_dedup.FingerprintIndex.open(spark, root)
    substring_dedup.FingerprintIndex(spark, 3, 2).save(root)
    for k in range(3):
        session = spark.newSession()
        index = substring_dedup.FingerprintIndex.open(session, root)
        assert not session.sql("SHOW TABLES").filter("tableName LIKE 'run_%'").count()
        assert rows(index.add(*(session.createDataFrame(d.toPandas(), "doc_id long, text binary") if d is not None else None for d in (batch(k), earlier(k))))) == wanted[k]
        index.save(root)
    assert any(wanted) and len(index.grams.tables) == 2
    index.close()


def test_map_columns(spark):
    """Rows equal in id and text that differ in a map, and maps in structs."""
    rows = [(1, "a", {"x": 1}), (1, "a", {"x": 2}), (2, "b", None), (2, "b", None), (3, "a", {})]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>").withColumn("s", F.struct("m"))
    got = exact_dedup.drop_exact_duplicates(df)
    assert got.dtypes == df.dtypes and sorted(r.doc_id for r in got.collect()) == [2, 3]


def test_line_dedup_is_native(docs):
    plan = line_dedup.repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("EvalPython", "InArrow", "InPandas"))


def test_many_lines_of_one_text(spark):
    """Time grows with the lines, not with lines times removed lines."""
    text = "\n".join(["one two three four five"] * 30_000 + [f"own line number {i} here" for i in range(30_000)])
    began = time.monotonic()
    got = line_dedup.repeated_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert got[0].n_lines == 60_000 and got[0].n_removed >= 59_998 and time.monotonic() - began < 60


def test_docs_schema_is_that_of_the_tables(spark, sf_dir):
    assert spark.createDataFrame([], DOCS).dtypes == spark.read.parquet(f"{sf_dir}/documents.parquet").dtypes
