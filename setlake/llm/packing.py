"""Best-fit packing of documents into token sequences by exact-complement hashing.

Documents are encoded where they lie; only piece lengths matter from there on. Lengths are at most
the sequence length, so their histogram has that many counters however large the corpus is, and the
packing is planned on it: for the longest length left, the gap to a full sequence is looked up among
single lengths, then sums of two, then sums of three, under what is still available; a combination
found is used as often as its rarest length allows. What no combination fills exactly is placed
best-fit by decreasing length. The plan is a list of patterns with multiplicities.

Pieces then take the slots of their length by rank. The rank is the place within a block of rows
plus the counts of the blocks before, so that a length that a third of all rows have is still spread.

Defined cases: a null or empty text is a document of one token (the end id); a very long text is encoded whole and cut into full
pieces behind the first; pieces of equal length are interchangeable and take their slots by row number; rows are documents of
their own even where ids repeat or are null; an empty table packs into nothing; only the two named columns are read, so
other columns may have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setlake.llm.common import arrow_rows, materialise
from setlake.llm.tokens import encoder

#: Ranks are counted within blocks of 2**BLOCK_BITS row numbers.
BLOCK_BITS = 16
Plan = list[tuple[tuple[int, ...], int]]


def _pair(have: np.ndarray, total: int) -> tuple[int, int] | None:
    """Two available lengths with the sum ``total``, the larger one as large as possible."""
    if total < 2:
        return None
    a = np.arange(total - 1, (total - 1) // 2, -1)
    b = total - a
    ok = (have[a] > 0) & (have[b] > 0) & ((a != b) | (have[a] > 1))
    hit = int(ok.argmax()) if ok.any() else -1
    return (int(a[hit]), int(b[hit])) if hit >= 0 else None


def _complement(have: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that exactly fill ``gap``, larger ones first."""
    if have[gap] > 0:
        return (gap,)
    if two := _pair(have, gap):
        return two
    for a in np.flatnonzero(have[: gap - 1])[::-1] if gap > 2 else ():
        if 3 * a < gap:  # a is the largest of the three
            break
        have[a] -= 1
        two = _pair(have, gap - int(a))
        have[a] += 1
        if two and two[0] <= a:
            return (int(a), *two)
    return None


def plan_packing(histogram: dict[int, int], capacity: int) -> Plan:
    """Patterns (lengths, how often) that hold every piece of ``histogram`` in sequences of ``capacity``."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        have[length] += n
    plan: Plan = []
    if have[capacity]:
        plan.append(((capacity,), int(have[capacity])))
        have[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while have[length]:
            have[length] -= 1
            rest = _complement(have, capacity - length)
            have[length] += 1
            if rest is None:
                break
            pattern = (length, *rest)
            times = min(int(have[x]) // pattern.count(x) for x in set(pattern))
            for x in pattern:
                have[x] -= times
            plan.append((pattern, times))
    return plan + _best_fit(have, capacity)


def _best_fit(have: np.ndarray, capacity: int) -> Plan:
    """Best fit by decreasing length; bins of one pattern are handled together."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern: tuple[int, ...], n: int) -> None:
        if n:
            open_bins.setdefault(capacity - sum(pattern), []).append((pattern, n))

    for length in np.flatnonzero(have)[::-1].tolist():
        left = int(have[length])
        while left:
            gap = min((g for g, bins in open_bins.items() if g >= length and bins), default=None)
            if gap is None:
                each = min(left, capacity // length)
                put((length,) * each, left // each)
                left %= each
                continue
            pattern, n = open_bins[gap].pop()
            fit = min(n, left)
            put(pattern, n - fit)
            put((*pattern, length), fit)
            left -= fit
    return [x for bins in open_bins.values() for x in bins]


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first may be shorter, the others are full."""
    first = n_tokens if n_tokens <= capacity else n_tokens % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n_tokens, capacity))]


def pieces(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    end = int(end_id).to_bytes(4, "little")

    def rows(ids: list, texts: list) -> dict:
        out: dict = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc, tokens in zip(ids, encoder(tokenizer)(texts), strict=True):
            tokens += end
            for k, (start, length) in enumerate(cut(len(tokens) // 4, capacity)):
                for name, value in zip(out, (doc, k, start, length, zlib.crc32(tokens[4 * start : 4 * (start + length)])), strict=True):
                    out[name].append(value)
        return out

    kind = dict(df.dtypes)[id_col]
    return arrow_rows(df.select(id_col, text_col), rows, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`pieces` with the place of each: sequence_id and offset."""
    cutting = pieces(df, tokenizer, capacity, end_id, id_col, text_col).withColumn("_row", F.monotonically_increasing_id())
    return place(materialise(cutting, "pieces"), capacity)


def place(cutting: DataFrame, capacity: int) -> DataFrame:
    """Gives rows with ``length`` and a unique long ``_row`` their sequence_id and offset."""
    blocked = cutting.withColumn("_block", F.shiftrightunsigned("_row", BLOCK_BITS))
    counts = blocked.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n"))
    counts = materialise(counts, "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most `capacity` rows
    slots = _slots(plan_packing(histogram, capacity), capacity)
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_block")) - F.col("_n")).drop("_n")
    rank = F.row_number().over(Window.partitionBy("length", "_block").orderBy("_row")) - 1
    ranked = blocked.withColumn("_rank", rank).join(before.hint("merge"), ["length", "_block"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    names = [c for c in cutting.columns if c != "_row"]
    shared = cutting.sparkSession.sparkContext.broadcast(slots)
    fields = ", ".join(f"`{n}` {t}" for n, t in cutting.dtypes if n != "_row") + ", sequence_id long, offset long"

    def assign(batches):
        starts, first, offsets, base = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            # slots are sorted by (length, first rank); a rank belongs to the last slot that begins at or before it
            at = np.searchsorted(starts, (length << np.int64(40)) + batch.column("_rank").to_numpy(), side="right") - 1
            sequence = base[at] + batch.column("_rank").to_numpy() - first[at]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offsets[at])], names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, F.col("_rank").cast("long").alias("_rank")).mapInArrow(assign, fields)


def _slots(plan: Plan, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each slot, sorted by length and rank: key of its first rank, that rank, offset, first sequence.

    Bounded by the plan, which each step of depletes a length: tens of thousands of slots at most.
    """
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            rows.append((length, int(used[length]), offset, sequence))
            used[length] += times
            offset += length
        sequence += times
    rows.sort()
    length, first, offsets, base = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4
    return (length << 40) + first, first, offsets, base
