"""Collocations: phrases of two to ``longest`` words that occur together more often than their parts suggest.

Phrases are mined level by level. A phrase can be frequent only if the phrases of a word less at its head and at its tail are, so a
document is a row of numbers, one a position: the number of the frequent phrase of the last level that begins there, or -1. A
phrase of the next level is two neighbouring numbers, one 64-bit key, exact by itself. Each level takes these steps:

* *Bound.* Tasks count the keys into hashed counters with ``bincount``; the arrays of all tasks are summed in a tree. A key whose
  counter stays below the least count isn't frequent. Counters are so many that one gets a ``CROWD``-th of the least count on average, whatever the
  size of the corpus: ``SLOTS`` of them a round, in as many rounds as it takes.
* *Candidates.* The distinct keys that pass the bound and whose two parts are frequent. A task passes one on only if it has its share there: a key
  that is short of ``least`` times a task's share of the places in every task is short of ``least`` in all. So none that is frequent is missing. Keys travel
  as sorted arrays, a piece of all hashes each, that are merged.
* *Count.* Candidates get slots of a minimal perfect hash (:mod:`setlake.llm.mph`), whose stored keys verify each lookup. Tasks count into one
  array by slot; arrays are cut into pieces and summed in a tree.
* *Number.* Slots of frequent phrases are the numbers of the next level.

Tasks hold ``SLOTS`` counters and at most ``CANDIDATES`` candidates; more are counted in as many rounds as it takes. Words of all kinds are counted
by Spark, frequent ones numbered, likewise at most ``WORDS`` a round. Cuts are read by number: each phrase's head and tail name their own counts. Scores are
divisions of 38-digit decimals, exact.

Defined cases: a null text is empty; a null language is ``und``, as that of rows that say so; only A-Z are lower-cased; documents are never joined, so
no phrase spans two; rows that share an id or are equal count each; texts and words of any length are whole; of equal scores the more frequent phrase comes first, then the
smaller in byte order; a language without a candidate has no row; an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlake.llm.common import begin_work, drop_scratch, materialise, release_shuffles, running_sums
from setlake.llm.mph import PerfectHash, build, mixed, spread

#: Counters of a round of a level's bound, candidates and words of a round, keys of a shard, counters of a piece. Together these bound what a task holds; what is broadcast besides is a bit a counter.
SLOTS, CANDIDATES, WORDS, SHARD, PIECE = 1 << 22, 1 << 21, 1 << 19, 1 << 16, 1 << 16
#: Pieces that candidates are dealt to by hash while they are merged.
KEY_PIECES = 256
#: Occurrences that a counter of the bound gets on average: the least count over this.
CROWD = 8
#: Distinct keys or words that a task holds before it passes them on, numbers that are looked up at once, and slots that are held for one ``bincount``.
HELD, CHUNK, LOT = 1 << 17, 1 << 19, 1 << 20
#: First stage of a tree of sums: tasks are dealt to so many branches.
BRANCHES = 16
#: Letters to lower case, a tab to a space, what ends a piece to a line feed.
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b" " + b"\n" * 9)
#: Stands between pieces; no byte of UTF-8.
_END = b"\xff"
#: A number that is no phrase.
_GAP = b"\xff\xff\xff\xff"


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8, with ``_END`` between pieces."""
    return (text or b"").translate(_FOLD).replace(b"\n", b" \xff ").split()


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that few values are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_counts(texts: DataFrame) -> DataFrame:
    """Rows lang, word, n."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                words.pop(_END, None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for batch in _slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, held.values())) > HELD:
                yield from out()
        yield from out()

    return texts.mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class _Numbers(dict):
    """Words to numbers; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def numbered(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """``texts`` as rows of the numbers of their frequent words (``frequent``: lang, word, id), one 32-bit number a word or end of piece. Words are looked up in rounds of ``WORDS`` or about so many."""
    spark = texts.sparkSession
    rounds = -(-frequent.count() // WORDS) or 1
    rows = texts.withColumn("ids", F.lit(None).cast("binary"))
    for own in range(rounds):
        known: dict[str, _Numbers] = {}
        for r in frequent.filter(F.pmod(F.xxhash64("lang", "word"), F.lit(rounds)) == own).toLocalIterator():
            known.setdefault(r["lang"], _Numbers())[r["word"].encode()] = r["id"]
        shared, final = spark.sparkContext.broadcast(known), own == rounds - 1

        def run(batches: Iterator[pa.RecordBatch], shared=shared, final=final) -> Iterator[pa.RecordBatch]:
            begin_work(__name__)
            none = _Numbers()
            for batch in _slices(batches):
                out = []
                for lang, text, before in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    ids = np.array(list(map(shared.value.get(lang, none).__getitem__, tokens(text))), np.int32)
                    out.append((np.maximum(ids, np.frombuffer(before, np.int32)) if before is not None else ids).tobytes())
                made = pa.array(out, pa.binary())
                yield pa.RecordBatch.from_arrays([made], names=["ids"]) if final else pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["lang", "text", "ids"])

        last, rows = rows, materialise(rows.mapInArrow(run, "ids binary" if final else "lang string, text string, ids binary"), "numbered")
        drop_scratch(spark, last)
        shared.unpersist()
    return rows


def _chunks(rows: list[bytes]) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows as long stretches of numbers with -1 behind each row: which rows, their numbers, and the positions where a number and the next are both phrases. A stretch has about CHUNK numbers, or one row."""
    start = size = 0
    for k, row in enumerate([*rows, b""]):
        if k == len(rows) or size + len(row) > 4 * CHUNK and k > start:
            if k > start:
                ids = np.frombuffer(_GAP.join(rows[start:k]) + _GAP, np.int32)
                yield slice(start, k), ids, np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            start, size = k, 0
        size += len(row) + 4


def _pairs(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ids[at].astype(np.uint64) << np.uint64(32) | ids[at + 1].astype(np.uint64)


def _pieces(task: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """An array of counts in pieces of ``PIECE``, in as narrow integers as hold them; pieces without a count are left out."""
    for k, start in enumerate(range(0, len(counts), PIECE)):
        part = counts[start : start + PIECE]
        if most := int(part.max(initial=0)):
            narrow = part.astype(np.min_scalar_type(most))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([task % BRANCHES], pa.int64()), pa.array([narrow.itemsize], pa.int64()), pa.array([narrow.tobytes()], pa.binary())], names=_PARTS)


_PARTS = ["piece", "branch", "width", "counts"]
_PART = "piece long, branch long, width long, counts binary"


def _one_piece(piece: int, branch: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([branch], pa.int64()), pa.array([8], pa.int64()), pa.array([counts.tobytes()], pa.binary())], names=_PARTS)


def _summed(parts: DataFrame, least: int | None = None) -> DataFrame:
    """Pieces summed in a tree, first within a branch, then over branches; a task holds one piece. With ``least`` the sums leave as bits: whether each reaches it."""
    def run(batches: Iterator[pa.RecordBatch], bits: bool) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        made = lambda piece, branch, counts: pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([np.packbits(counts >= least, bitorder="little").tobytes()], pa.binary())], names=["piece", "bits"]) if bits else _one_piece(piece, branch, counts)
        held, key = None, None
        for batch in _slices(batches, 16):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != row[:2] and held is not None:
                    yield made(*key, held)
                    held = None
                part = np.frombuffer(row[3], np.dtype(f"u{row[2]}")).astype(np.uint64)
                held, key = part if held is None else held + part, row[:2]
        if held is not None:
            yield made(*key, held)

    parts = parts.repartition("piece", "branch").sortWithinPartitions("piece", "branch").mapInArrow(lambda b: run(b, False), _PART)
    parts = parts.withColumn("branch", F.lit(0).cast("long")).repartition("piece").sortWithinPartitions("piece")
    return parts.mapInArrow(lambda b: run(b, False), _PART) if least is None else parts.mapInArrow(lambda b: run(b, True), "piece long, bits binary")


def _reaching(pieces: DataFrame, least: int) -> DataFrame:
    """One bit for each counter of pieces: whether it reaches ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(c, np.uint64) >= least, bitorder="little").tobytes() for c in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], names=["piece", "bits"])

    return pieces.mapInArrow(run, "piece long, bits binary")


def _gathered(bits: DataFrame, n: int) -> np.ndarray:
    """The bits of ``n`` counters of a round. The driver gets n / 8 bytes, bounded by SLOTS and CANDIDATES."""
    out = np.zeros(-(-n // PIECE) * PIECE // 8, np.uint8)
    for r in bits.collect():
        out[r["piece"] * PIECE // 8 :][: len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out


def _on(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _counted(rows: DataFrame, n: int, slots: Callable[[np.ndarray], np.ndarray], least: int | None = None) -> DataFrame:
    """Pieces of the sum of all tasks' counts of the slots (below ``n``, or -1) of keys, or their bits by ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        begin_work(__name__)
        counts, lot = np.zeros(n, np.uint32), []
        for batch in chain(_slices(batches), [None]):
            for _, ids, at in _chunks(batch.column(0).to_pylist()) if batch is not None else ():
                found = slots(_pairs(ids, at))
                lot.append(found[found >= 0].astype(np.uint32))
            if lot and (batch is None or sum(map(len, lot)) > LOT):
                counts += np.bincount(np.concatenate(lot), minlength=n).astype(np.uint32)  # of one task: it has less than 2**32 words
                lot.clear()
        yield from _pieces(TaskContext.get().partitionId(), counts)

    return _summed(rows.mapInArrow(run, _PART), least)


def _bounded(rows: DataFrame, least: int, places: int) -> np.ndarray:
    """Which hashed counters reach ``least``; ``places`` is how many keys there are at most."""
    n, rounds = SLOTS, -(-CROWD * places // (least * SLOTS)) or 1

    def slots(keys: np.ndarray, own: int) -> np.ndarray:
        at = _counter(keys, n * rounds)
        return np.where(at // n == own, at % n, -1) if rounds > 1 else at

    return np.concatenate([_gathered(_counted(rows, n, lambda keys, own=own: slots(keys, own), least), n)[: n // 8] for own in range(rounds)])


def _counter(keys: np.ndarray, n: int) -> np.ndarray:
    return (mixed(keys, 62) % np.uint64(n)).astype(np.int64)


def _split(keys: np.ndarray, by: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Keys by number."""
    order = np.argsort(by, kind="stable")
    numbers, starts = np.unique(by[order], return_index=True)
    yield from zip(numbers.tolist(), np.split(keys[order], starts[1:]), strict=True)


def _candidates(rows: DataFrame, bound: np.ndarray, least: int, places: int) -> DataFrame:
    """The distinct keys that may be frequent: rows piece, n, keys."""
    shared, n, most = rows.sparkSession.sparkContext.broadcast(bound), 8 * len(bound), HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        held, counts, here = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for batch in chain(_slices(batches), [None]):
            for _, ids, at in _chunks(batch.column(0).to_pylist()) if batch is not None else ():
                keys = _pairs(ids, at)
                here += len(keys)
                keys, found = np.unique(keys[_on(shared.value, _counter(keys, n))], return_counts=True)
                held, back = np.unique(np.concatenate([held, keys]), return_inverse=True)
                counts = np.bincount(back, weights=np.concatenate([counts, found]), minlength=len(held)).astype(np.int64)
            if here and (batch is None or len(held) > most):
                keys = held[counts * places >= least * here]
                for piece, part in _split(keys, spread(keys) % KEY_PIECES) if len(keys) else ():
                    yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["piece", "keys"])
                held, counts, here = held[:0], counts[:0], 0

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        held, piece = np.zeros(0, np.uint64), None
        for batch in chain(_slices(batches, 64), [None]):
            for number, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if batch is not None else [(None, b"")]:
                if number != piece:
                    if len(held):
                        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([len(held)], pa.int64()), pa.array([held.tobytes()], pa.binary())], names=["piece", "n", "keys"])
                    held, piece = held[:0], number
                held = np.union1d(held, np.frombuffer(keys, np.uint64))

    parts = rows.mapInArrow(run, "piece long, keys binary").repartition("piece").sortWithinPartitions("piece")
    return parts.mapInArrow(merge, "piece long, n long, keys binary")


def _hashed(candidates: DataFrame, n: int, rounds: int, own: int) -> PerfectHash:
    """The perfect hash of a round, at most CANDIDATES keys or about so many, from shards that tasks build."""
    n_shards = -(-n // rounds // SHARD) or 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 16):
            keys = np.concatenate([np.frombuffer(k, np.uint64) for k in batch.column(0).to_pylist()])
            dealt = spread(keys)
            mine = dealt % rounds == own
            for shard, part in _split(keys[mine], dealt[mine] // rounds % n_shards) if mine.any() else ():
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["shard", "keys"])

    def built(group: pa.Table) -> pa.Table:
        levels = build(np.sort(np.concatenate([np.frombuffer(k, np.uint64) for k in group.column("keys").to_pylist()])))
        return pa.table({"shard": [group.column("shard")[0].as_py()] * len(levels), "level": list(range(len(levels))), "bits": [b.tobytes() for b, _ in levels], "keys": [k.tobytes() for _, k in levels]}, pa.schema([("shard", pa.int64()), ("level", pa.int64()), ("bits", pa.binary()), ("keys", pa.binary())]))

    shards: dict[int, list] = {}
    dealt = candidates.select("keys").mapInArrow(deal, "shard long, keys binary")
    for r in dealt.groupBy("shard").applyInArrow(built, "shard long, level long, bits binary, keys binary").orderBy("shard", "level").collect():
        shards.setdefault(r["shard"], []).append((np.frombuffer(r["bits"], np.uint64), np.frombuffer(r["keys"], np.uint64)))
    return PerfectHash(shards, n_shards, rounds, own)


def _level(rows: DataFrame, least: int, places: int, onward: bool) -> tuple[DataFrame, DataFrame | None]:
    """The frequent phrases of the next level (id, head, tail, n; head and tail are numbers of this one), and the rows in their numbers if wanted. ``places``: how many numbers there are."""
    spark = rows.sparkSession
    candidates = materialise(_candidates(rows, _bounded(rows, least, places), least, places), "candidates")
    n = candidates.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rounds, found, base, turned = -(-n // CANDIDATES) or 1, None, 0, rows.select("ids", F.lit(None).cast("binary").alias("next"))
    for own in range(rounds):
        table = _hashed(candidates, n, rounds, own)
        shared = spark.sparkContext.broadcast(table)
        pieces = materialise(_counted(rows, len(table), lambda keys, s=shared: s.value.slots(keys)), "counts")

        def frequent(batches: Iterator[pa.RecordBatch], shared=shared, base=base) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece, counts in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    counts = np.frombuffer(counts, np.uint64).astype(np.int64)
                    at = np.flatnonzero(counts >= least)
                    keys = shared.value.keys[piece * PIECE + at]
                    yield pa.RecordBatch.from_arrays([pa.array(base + piece * PIECE + at), pa.array((keys >> np.uint64(32)).astype(np.int64)), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts[at])], names=["id", "head", "tail", "n"])

        own_found = materialise(pieces.mapInArrow(frequent, "id long, head long, tail long, n long"), "frequent")
        found = own_found if found is None else found.unionByName(own_found)
        if onward:
            reached, last_round = spark.sparkContext.broadcast(_gathered(_reaching(pieces, least), len(table))), own == rounds - 1

            def turn(batches: Iterator[pa.RecordBatch], shared=shared, reached=reached, base=base, own=own, last_round=last_round) -> Iterator[pa.RecordBatch]:
                begin_work(__name__)
                for batch in _slices(batches):
                    rows, before = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                    for part, ids, at in _chunks(rows):
                        new = np.full(len(ids), -1, np.int32)
                        slots = shared.value.slots(_pairs(ids, at))
                        at, slots = at[slots >= 0], slots[slots >= 0]
                        on = _on(reached.value, slots)
                        new[at[on]] = base + slots[on]
                        if own:
                            new = np.maximum(new, np.frombuffer(b"".join(before[part]), np.int32))
                        ends = np.cumsum([0, *(len(row) + 4 for row in rows[part])])
                        made = pa.array([new[i // 4 : j // 4].tobytes() for i, j in zip(ends, ends[1:], strict=False)], pa.binary())
                        if last_round:  # rows without a phrase go
                            yield pa.RecordBatch.from_arrays([made], names=["ids"]).filter(pa.array(np.maximum.reduceat(new, ends[:-1] // 4) >= 0))
                        else:
                            yield pa.RecordBatch.from_arrays([batch.column(0)[part], made], names=["ids", "next"])

            last, turned = turned, materialise(turned.mapInArrow(turn, "ids binary" if last_round else "ids binary, next binary"), "turned")
            drop_scratch(spark, last)
        drop_scratch(spark, pieces)
        base += len(table)
        shared.unpersist()
        release_shuffles(spark)
    drop_scratch(spark, candidates)
    return found, turned if onward else None


def _score(a: str, n: str, left: Column, right: Column) -> Column:
    whole = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * whole(F.col(a)) * whole(F.col(n)), (whole(left) * whole(right)).cast("decimal(38,0)"))


def phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", *, longest: int = 5, least: int = 100, absorb: int = 100) -> DataFrame:
    """All candidates that stay: lang, phrase, a, l, r, n, score. One goes if a longer one that holds it has ``absorb`` percent of its occurrences."""
    texts = _texts(df, text_col, lang_col)
    counts = materialise(word_counts(texts), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    one = running_sums(counts.filter(F.col("n") >= least).withColumn("one", F.lit(1)), [], [F.col("lang").asc(), F.col("word").asc()], ["one"])
    words = materialise(one.select("lang", "word", "n", F.col("before_one").alias("id")), "frequent")
    rows = numbered(texts, words.select("lang", "word", "id"))
    series = lambda: F.array(F.col("n"))
    level = words.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), series().alias("heads"), series().alias("tails"), "n")
    out = None
    for length in range(2, longest + 1):
        found, turned = _level(rows, least, level.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], length < longest)
        drop_scratch(df.sparkSession, rows)
        rows = turned
        first = level.select(F.col("id").alias("head"), "lang", "phrase", "heads")
        rest = level.select(F.col("id").alias("tail"), "last", "tails")
        new = found.join(first, "head").join(rest, "tail").select("id", "head", "tail", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", F.concat("heads", series()).alias("heads"), F.concat("tails", series()).alias("tails"), "n")
        new = materialise(new, "level")
        if length > 2:
            part = materialise(_unabsorbed(level, new, absorb), "phrases")
            out = part if out is None else out.unionByName(part)
        level = new
        if rows is None or not level.limit(1).count():
            break
    last = level.select("lang", "phrase", F.col("n").alias("a"), "heads", "tails")
    out = last if out is None else out.unionByName(last)
    size = F.size("heads")
    each = out.join(totals, "lang").withColumn("cuts", F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        _score("a", "total", F.element_at("heads", k), F.element_at("tails", size - k)).alias("score"), k.alias("k"), F.element_at("heads", k).alias("l"), F.element_at("tails", size - k).alias("r"))))
    lowest = F.array_min("cuts")
    return each.select("lang", "phrase", "a", lowest["l"].alias("l"), lowest["r"].alias("r"), F.col("total").alias("n"), lowest["score"].alias("score"))


def _unabsorbed(level: DataFrame, longer: DataFrame, absorb: int) -> DataFrame:
    """Phrases that no phrase of a word more takes in. Longer ones need no look: they are no more frequent than one of these that they hold."""
    inside = longer.select(F.explode(F.array("head", "tail")).alias("id"), "n").groupBy("id").agg(F.max("n").alias("most"))
    left = level.join(inside, "id", "left").filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("n") * absorb))
    return left.select("lang", "phrase", F.col("n").alias("a"), "heads", "tails")


def top_phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", *, top: int = 2000, **settings) -> DataFrame:
    """The first ``top`` phrases of each language with their rank: lang, rank, phrase, a, l, r, n, score. ``settings`` are those of :func:`phrases`."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = phrases(df, text_col, lang_col, **settings).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
