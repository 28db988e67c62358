"""Substring deduplication over a log-structured index of window fingerprints.

A window is ``WINDOW`` consecutive words. Of equal windows all but the first (smallest id, then
smallest start) are removed, word by word. Documents come in batches of ascending keys; each batch is
compared to the index of all batches before it.

Anchors. Every window picks, of its ``GRAM``-word grams, the leftmost one with the smallest hash.
Equal windows pick equal grams, so one row per run of windows with the same anchor (a *segment*) is
enough: gram hash, segment hash, place. That is about one row per seven words.

Index. A run has one row per gram hash: the first segment, its digest, and whether segments differ
(``state``: 0 once, 1 repeated alike, 2 repeated and different). A run is sorted and bucketed by its
key and never changed. A new batch is combined in each task, so that a gram of a third of all rows
leaves a task as one row, becomes a run of its own, and is merge-joined with the older runs without
a shuffle. Where there are ``FAN`` runs already they are compacted into one first.

Verification. The hashes of grams are polynomials modulo 2**64, for which equal values of different
words can be made up; they only name candidates. What is removed is decided by BLAKE2b digests of the words
themselves (128 bits, for which nobody can do that). Where all segments of a gram have one digest, every one but the
first goes as a whole. Where they differ (different grams of one hash do too), their windows are compared one by one by
their own digests; first places of such windows form a second set of runs, sorted, merge-joined and compacted like the first.

Bloom filters (bounded, 2**28 bits) name the grams that matter, so that only their rows leave the
second scan of a batch; false positives cost rows and change nothing.

Defined cases: null, empty and short texts have no window and lose nothing; very long texts are hashed ``_SLICE`` words at
once, windows over the borders included; of equal windows within a document the earliest stays; rows that share an id or
have none are documents of their own (see ``with_key``); an empty table gives an empty result; columns of any name pass
through.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from hashlib import blake2b
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlake.llm.common import arrow_rows, at_path, begin_work, drop_scratch, materialise, numbered_columns, release_shuffles, scratch, with_key
from setlake.sinks.manifest import Store

WINDOW, GRAM = 20, 8
#: Runs of a kind that the index keeps before it compacts them, and batches that a table is taken in.
FAN, BATCHES = 2, 3
#: Words hashed at once in a long text, and anchor rows that a task combines at once.
_SLICE, _COMBINE = 1 << 16, 1 << 18
#: Upper bound of a Bloom filter, in bits.
MAX_BITS = 1 << 28
_U = np.uint64
_ALL = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Rolling:
    """Hashes of any stretch of a byte string from prefix sums: polynomials modulo 2**64 over a table of random byte values."""

    def __init__(self, seed: int) -> None:
        self.base = (seed * 0x9E3779B97F4A7C15 | 5) & ~2 & _ALL
        self.values = _mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))
        self.powers = self.inverse = np.ones(1, _U)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(size, base, _U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=_U))

    def stretches(self, data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(self.values[data] * self.powers[: len(data)], dtype=_U, out=sums[1:])
        return lambda start, stop: _mix((sums[stop] - sums[start]) * self.inverse[start])


_GRAMS = _Rolling(42)


class Segments:
    """Anchored segments of several documents: arrays gram, key, lo, n, and digests of segments and windows on demand.

    ``parts`` are (key, words, number of the first of these words). The words lie behind each other in one
    array, so that small documents share the cost of a call; windows across their borders don't count.
    """

    def __init__(self, parts: list[tuple[int, list[bytes], int]]) -> None:
        words = [w for _, part, _ in parts for w in part]
        sizes = np.array([len(part) for _, part, _ in parts], np.int64)
        document = np.repeat(np.arange(len(parts)), sizes)
        self._data = b" ".join(words)
        self._stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        self._starts = np.concatenate([[0], self._stops[:-1] + 1])
        grams = _GRAMS.stretches(np.frombuffer(self._data, np.uint8))(self._starts[: len(words) - GRAM + 1], self._stops[GRAM - 1 :])
        least, at = grams[: len(words) - WINDOW + 1].copy(), np.zeros(len(words) - WINDOW + 1, np.int64)
        for k in range(1, WINDOW - GRAM + 1):
            other = grams[k : k + len(least)]
            np.copyto(at, k, where=other < least)  # the leftmost of equal grams stays
            np.minimum(least, other, out=least)
        whole = np.flatnonzero(document[: len(least)] == document[WINDOW - 1 :])
        anchor = whole + at[whole]
        cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(whole) > 1), [True]])) if len(whole) else np.zeros(1, np.int64)
        self._lo, self.n = whole[cut[:-1]], np.diff(cut)
        self.gram = grams[anchor[cut[:-1]]].view(np.int64)
        self.key = np.array([key for key, _, _ in parts], np.int64)[document[self._lo]]
        self._shift = (np.array([base for _, _, base in parts], np.int64) - np.cumsum(sizes) + sizes)[document[self._lo]]
        self.lo = self._lo + self._shift

    def _digests(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Two rows: the digests of ``n`` words from word ``first`` on."""
        data, spans = self._data, zip(self._starts[first].tolist(), self._stops[first + n - 1].tolist(), strict=True)
        return np.frombuffer(b"".join([blake2b(data[a:b], digest_size=16).digest() for a, b in spans]), "<i8").reshape(-1, 2).T

    def segments(self, which: np.ndarray) -> np.ndarray:
        """Digests of the segments ``which``."""
        return self._digests(self._lo[which], self.n[which] + WINDOW - 1)

    def windows(self, which: np.ndarray) -> np.ndarray:
        """Rows (digest in two parts, key, start) of every window of the segments ``which``."""
        n = self.n[which]
        start = np.repeat(self._lo[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.stack([*self._digests(start, np.full(len(start), WINDOW)), np.repeat(self.key[which], n), start + np.repeat(self._shift[which], n)])


def segments(keys: list[int], texts: pa.Array) -> Iterator[Segments]:
    """Segments of the windows of ``texts``, about ``_SLICE`` words at once."""
    held, size = [], 0
    for key, text in zip(keys, texts, strict=True):
        words = (text.as_py() or b"").split()
        for at in range(0, len(words) - WINDOW + 1, _SLICE):
            part = words[at : at + _SLICE + WINDOW - 1]
            held.append((key, part, at))
            size += len(part)
            if size >= _SLICE:
                yield Segments(held)
                held, size = [], 0
    if held:
        yield Segments(held)


def _combined(rows: np.ndarray) -> np.ndarray:
    """One row per gram of rows (gram, s1, s2, key, lo, state): the earliest place, and the state of all."""
    rows = rows[:, np.lexsort((rows[4], rows[3], rows[0]))]
    first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
    low, high = (f.reduceat(rows[1:3], first, axis=1) for f in (np.minimum, np.maximum))
    state = np.maximum(np.maximum.reduceat(rows[5], first), np.diff(np.append(first, rows.shape[1])) > 1)
    out = rows[:, first]
    out[5] = np.where((low != high).any(axis=0), 2, state)
    return out


def _grams(docs: DataFrame) -> DataFrame:
    """``docs`` (key, text as bytes) to rows gram, s1, s2 (digest of the segment), key, lo, state, combined within each task."""
    names = ["gram", "s1", "s2", "key", "lo", "state"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        held, size = [], 0

        def out() -> pa.RecordBatch:
            rows = _combined(np.concatenate(held, axis=1))
            return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=names)

        for batch in batches:
            for s in segments(batch.column(0).to_pylist(), batch.column(1)):
                held.append(np.stack([s.gram, *s.segments(np.arange(len(s.lo))), s.key, s.lo, np.zeros(len(s.lo), np.int64)]))
                size += len(s.lo)
                if size >= _COMBINE:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _merged_grams(rows: DataFrame) -> DataFrame:
    """One row per gram of rows (gram, s1, s2, key, lo, state)."""
    ends = [f(c).alias(f"{c}_{i}") for c in ("s1", "s2") for i, f in enumerate((F.min, F.max))]
    all_ = rows.groupBy("gram").agg(F.min(F.struct("key", "lo", "s1", "s2")).alias("f"), F.max("state").alias("s"), F.count(F.lit(1)).alias("c"), *ends)
    state = F.when((F.col("s") == 2) | (F.col("s1_0") != F.col("s1_1")) | (F.col("s2_0") != F.col("s2_1")), 2).when(F.col("c") > 1, 1).otherwise(F.col("s"))
    return all_.select("gram", "f.s1", "f.s2", "f.key", "f.lo", state.cast("long").alias("state"))


def _merged_windows(rows: DataFrame) -> DataFrame:
    """The first place of each window of rows (h, h2, key, lo)."""
    return rows.groupBy("h", "h2").agg(F.min(F.struct("key", "lo")).alias("f")).select("h", "h2", "f.key", "f.lo")


def _earliest(windows: DataFrame) -> DataFrame:
    """Rows h, h2, key, lo with one row per window of each ``_COMBINE`` rows of a task, so that a window of a third of all rows is few before it is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(np.stack([c.to_numpy() for c in batch.columns]))
                size += batch.num_rows
            if size and (batch is None or size >= _COMBINE):
                rows = np.concatenate(held, axis=1)
                rows = rows[:, np.lexsort(rows[::-1])]
                rows = rows[:, np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])]
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["h", "h2", "key", "lo"])
                held, size = [], 0

    return windows.mapInArrow(run, "h long, h2 long, key long, lo long")


def _bloom(keys: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter (two bits a key, 16 bits of space a key, MAX_BITS at most) over a long column of about ``n`` keys, built by bitmap aggregates."""
    bits = min(MAX_BITS, max(1 << 15, 1 << (16 * n).bit_length()))
    filled = np.zeros(bits // 8, np.uint8)
    if n:
        k = F.col(keys.columns[0])
        spots = keys.select(F.explode(F.array(F.pmod(k, F.lit(bits)), F.pmod(F.shiftright(k, 30), F.lit(bits)))).alias("i"))
        blocks = spots.groupBy(F.floor(F.col("i") / (1 << 15)).alias("b")).agg(F.bitmap_construct_agg(F.col("i") % (1 << 15)).alias("m"))
        for r in blocks.collect():  # at most MAX_BITS / 2**15 blocks of 4 KB, 32 MB
            filled[r["b"] * 4096 : (r["b"] + 1) * 4096] = np.frombuffer(r["m"], np.uint8)
    return filled


def _maybe(filled: np.ndarray, keys: np.ndarray) -> np.ndarray:
    mask = len(filled) * 8 - 1
    one, two = keys & mask, (keys >> 30) & mask
    return ((filled[one >> 3] >> (one & 7).astype(np.uint8)) & (filled[two >> 3] >> (two & 7).astype(np.uint8)) & 1).astype(bool)


def _scan(docs: DataFrame, whole: np.ndarray | None, differ: np.ndarray, keys: np.ndarray | None = None) -> DataFrame:
    """``docs`` (key, text as bytes) to rows h, h2, key, lo, n of the grams that the filters name.

    For a segment: gram, 0, first window, number of windows. For a window of a gram in ``differ``: its digest,
    its start, 0. ``keys`` restricts the documents.
    """
    names, shared = ["h", "h2", "key", "lo", "n"], docs.sparkSession.sparkContext.broadcast((whole, differ, keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        whole, differ, keys = shared.value
        for batch in batches:
            if keys is not None:
                batch = batch.filter(pa.array(_maybe(keys, batch.column(0).to_numpy())))
            for s in segments(batch.column(0).to_pylist(), batch.column(1)):
                held = []
                if whole is not None and len(at := np.flatnonzero(_maybe(whole, s.gram))):
                    held.append(np.stack([s.gram[at], np.zeros(len(at), np.int64), s.key[at], s.lo[at], s.n[at]]))
                if len(at := np.flatnonzero(_maybe(differ, s.gram))):
                    found = s.windows(at)
                    held.append(np.concatenate([found, np.zeros((1, found.shape[1]), np.int64)]))
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(r) for r in np.concatenate(held, axis=1)], names=names)

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


class Runs:
    """Sorted immutable runs of one kind, one row per key in each.

    A run is a table bucketed and sorted by its keys, so that later joins on them need neither an exchange nor a sort.
    """

    def __init__(self, spark: SparkSession, keys: list[str], merge: Callable[[DataFrame], DataFrame], buckets: int, fan: int) -> None:
        self.spark, self.keys, self.merge, self.buckets, self.fan = spark, keys, merge, buckets, fan
        self.tables: dict[str, DataFrame] = {}

    def write(self, rows: DataFrame) -> DataFrame:
        """A new run of ``rows``, which is among the others from now on."""
        path = scratch(self.spark, "run")
        name = "run_" + path.rsplit("-", 1)[1]
        merged = self.merge(rows.repartition(self.buckets, *self.keys)).sortWithinPartitions(*self.keys)
        merged.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", path).saveAsTable(name)
        return self._known(name, path)

    def _known(self, name: str, path: str) -> DataFrame:
        """The run as a table whose plan knows its buckets; the catalogue's entry is needed no longer than that."""
        self.tables[path] = at_path(self.spark.table(name), path)
        self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        return self.tables[path]

    def adopt(self, path: str) -> None:
        """Take in a run that another session wrote."""
        name, keys = "run_" + path.rsplit("-", 1)[1], ", ".join(self.keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        self._known(name, path)

    def beside(self, run: DataFrame) -> tuple[DataFrame, list[Column]]:
        """``run`` with the rows of the same keys of all other runs, merge-joined, and the columns that hold them as structs."""
        old = [t for t in self.tables.values() if t is not run]
        values = [c for c in run.columns if c not in self.keys]
        for k, table in enumerate(old):
            run = run.join(table.select(*self.keys, F.struct(*values).alias(f"r{k}")).hint("merge"), self.keys, "left")
        return run, [F.col(f"r{k}") for k in range(len(old))]

    def compact(self) -> None:
        """Merge all runs into one if there are ``fan`` of them."""
        old = dict(self.tables)
        if len(old) >= max(self.fan, 2):
            self.write(reduce(DataFrame.unionByName, old.values()))
            self.drop(old)

    def drop(self, paths: Iterable[str]) -> None:
        for path in list(paths):
            drop_scratch(self.spark, self.tables.pop(path))


class FingerprintIndex:
    """The runs of all batches so far: of grams, and of windows whose grams differ. Batches must come in ascending order of keys.

    :meth:`save` and :meth:`open` carry it from session to session: a small manifest names the runs, which stay where they are.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan: int = FAN) -> None:
        self.spark = spark
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.grams = Runs(spark, ["gram"], _merged_grams, buckets, fan)
        self.windows = Runs(spark, ["h", "h2"], _merged_windows, buckets, fan)

    def save(self, root: str) -> None:
        """Publish the runs of this moment under ``root`` as the next manifest."""
        store, runs = Store(self.spark, root), {"grams": self.grams, "windows": self.windows}
        number = max((int(n[:8]) for n in store.listed("") if n[:8].isdigit()), default=0) + 1
        if not store.put(f"{number:08d}.json", json.dumps({"buckets": self.grams.buckets, "fan": self.grams.fan} | {k: list(r.tables) for k, r in runs.items()})):
            raise RuntimeError(f"another session saved manifest {number} of {root}")

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> FingerprintIndex:
        """The index as it was last saved under ``root``."""
        store = Store(spark, root)
        last = max((n for n in store.listed("") if n[:8].isdigit()), default=None)
        if last is None:
            raise FileNotFoundError(f"no index is saved in {root}")
        saved = json.loads(store.text(last))
        index = cls(spark, saved["buckets"], saved["fan"])
        for name, runs in (("grams", index.grams), ("windows", index.windows)):
            for path in saved[name]:
                runs.adopt(path)
        return index

    def close(self) -> None:
        """Delete all runs."""
        for runs in (self.grams, self.windows):
            runs.drop(runs.tables)

    def add(self, docs: DataFrame, earlier: DataFrame | None) -> DataFrame:
        """Index a batch (``_key``, ``_text`` as bytes) and return what to remove of it: rows key, lo, n (n windows from word lo on).

        ``earlier`` are the documents of all batches before; those of grams that this batch makes differ are scanned again.
        """
        spark = self.spark
        for runs in (self.grams, self.windows):
            runs.compact()
        seen, olds = self.grams.beside(self.grams.write(_grams(docs)))
        release_shuffles(spark)
        other = lambda a, b: F.coalesce((a["s1"] != b["s1"]) | (a["s2"] != b["s2"]), F.lit(False))
        here = F.struct("s1", "s2", "key", "lo", "state")
        places = [F.when(x.isNotNull(), F.struct(x["key"].alias("key"), x["lo"].alias("lo"))) for x in (here, *olds)]
        first = F.least(*places) if olds else places[0]  # least() passes over nulls
        was = reduce(Column.__or__, [F.coalesce(x["state"] == 2, F.lit(False)) | reduce(Column.__or__, [other(x, y) for y in olds[:k]], F.lit(False)) for k, x in enumerate(olds)], F.lit(False))
        known = reduce(Column.__or__, [x.isNotNull() for x in olds], F.lit(False))
        differs = (F.col("state") == 2) | was | reduce(Column.__or__, [other(x, here) for x in olds], F.lit(False))
        named = seen.filter((F.col("state") > 0) | known).select("gram", first.alias("f"), differs.alias("differs"), (differs & known & ~was).alias("new"))
        facts = materialise(named.select("gram", F.col("f.key").alias("fkey"), F.col("f.lo").alias("flo"), "differs", "new"), "facts")
        n = facts.agg(F.count(F.lit(1)).alias("all"), F.count_if("differs").alias("differs"), F.count_if("new").alias("new")).first()
        differ = _bloom(facts.filter("differs").select("gram"), n["differs"])
        found = materialise(_scan(docs, _bloom(facts.select("gram"), n["all"]), differ), "found")
        windows = found.filter("n = 0").select("h", "h2", "key", "lo")
        every, new = windows, facts.filter("new")
        if earlier is not None and n["new"]:
            # all earlier segments of such a gram are alike, so the document of the first one has all its windows
            extra = _scan(earlier, None, _bloom(new.select("gram"), n["new"]), _bloom(new.select("fkey").distinct(), n["new"])).select("h", "h2", "key", "lo")
            every = windows.unionByName(extra)
        met, olds = self.windows.beside(self.windows.write(_earliest(every)))
        here = F.struct("key", "lo")
        starts = materialise(met.select("h", "h2", F.least(here, *olds).alias("f") if olds else here.alias("f")), "starts")
        whole = found.filter("n > 0").join(facts.withColumnRenamed("gram", "h"), "h").filter("NOT differs AND (key <> fkey OR lo <> flo)").select("key", "lo", "n")
        single = windows.join(starts, ["h", "h2"]).filter(here != F.col("f")).select("key", "lo", F.lit(1).cast("long").alias("n"))
        gone = materialise(whole.unionByName(single), "gone")
        drop_scratch(spark, found, facts, starts)
        release_shuffles(spark)
        return gone


def removed_words(n_words: int, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which words the given stretches of windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, lo + n + WINDOW - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _cleaned(text: bytes | None, gone: list[int] | None) -> tuple[int, int, bytes | None]:
    """Words, removed words, and the kept words joined by spaces."""
    words = (text or b"").split()
    if gone is None or not len(gone):
        return len(words), 0, b" ".join(words)
    packed = np.array(gone, np.int64)
    off = removed_words(len(words), packed >> 24, packed & 0xFFFFFF)
    return len(words), int(off.sum()), b" ".join(w for w, x in zip(words, off.tolist(), strict=True) if not x)


def _with_removals(df: DataFrame, batches: int, id_col: str, text_col: str) -> Iterator[DataFrame]:
    """For each batch: ``df`` with ``_key`` and ``_gone`` (packed stretches)."""
    spark = df.sparkSession
    keyed, _ = with_key(df, id_col, text_col)
    bounds = sorted(set(keyed.approxQuantile("_key", [k / batches for k in range(1, batches)], 0.01))) if batches > 1 else []
    index, key = FingerprintIndex(spark), F.col("_key")
    try:
        for low, high in zip([None, *bounds], [*bounds, None], strict=True):
            part = keyed if low is None else keyed.filter(key > low)
            part = part if high is None else part.filter(key <= high)
            as_bytes = lambda d: d.select(key, F.col(text_col).cast("binary"))
            gone = index.add(as_bytes(part), None if low is None else as_bytes(keyed.filter(key <= low)))
            packed = gone.groupBy("key").agg(F.collect_list(F.shiftleft("lo", 24) + F.col("n")).alias("_gone")).withColumnRenamed("key", "_key")
            yield part.join(packed, "_key", "left")
    finally:
        index.close()


def repeated_words(df: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_removed, kept_sha256."""

    def rows(ids: list, texts: list, gone: list) -> dict:
        done = [_cleaned(t, g) for t, g in zip(texts, gone, strict=True)]
        return {"doc_id": ids, "n_words": [d[0] for d in done], "n_removed": [d[1] for d in done], "kept_sha256": [hashlib.sha256(d[2]).hexdigest() for d in done]}

    schema = f"doc_id {dict(df.dtypes)[id_col]}, n_words long, n_removed long, kept_sha256 string"
    out, named = None, df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    for part in _with_removals(named, batches, "doc_id", "text"):
        done = materialise(arrow_rows(part.select("doc_id", F.col("text").cast("binary"), "_gone"), rows, schema), "kept")
        release_shuffles(df.sparkSession)
        out = done if out is None else out.unionByName(done)
    return out


def drop_repeats(df: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with repeated passages taken out of its texts (kept words joined by one space); unrepeated texts stay as they are."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([t if g is None else _cleaned(t.encode(), g)[2].decode() for t, g in zip(texts, gone, strict=True)], dtype=object)

    inner, (ident, text) = numbered_columns(df, id_col, text_col)
    out = None
    for part in _with_removals(inner, batches, ident, text):
        done = part.withColumn(text, clean(F.col(text), F.col("_gone"))).select(inner.columns)
        out = done if out is None else out.unionByName(done)
    return out.toDF(*df.columns)
