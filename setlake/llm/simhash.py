"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits come from word shingles. Two fingerprints are linked if they differ in at
most ``radius`` bits. Candidates come from 2**(radius+1) - 1 tables: bit position *i* has a non-zero
code of radius+1 bits, and table *v* keeps the positions whose code has an odd number of ones in
common with *v*. The codes of up to ``radius`` differing positions span too little to meet every
*v*, so some table keeps none of the differing positions and the pair collides in it for certain.

Equal fingerprints are one node from the start. Within a bucket, small groups are compared directly
and larger ones yield a spanning forest of their links, so what leaves a bucket is in proportion to
its rows. Buckets over ``bucket_rows`` are found by counting and take another exact way: their
fingerprints emit every variant within radius 3 split as 2 + 1 flipped bits, and members of a variant
are linked to its smallest member that is one flip away; a variant has at most 2,081 members.

Defined cases: null, empty and blank texts have fingerprint zero; very long texts are hashed whole; a bit that just half of the
hashes set is zero; repeated rows are nodes of one fingerprint; rows that share an id, or have none, are documents of their own
(see ``with_key``), and the smallest id of a group, ties by that order, is its component; an empty table gives an empty result; columns of any name pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlake.llm.common import arrow_rows, begin_work, materialise, numbered_columns, release_shuffles, with_key
from setlake.llm.components import components

#: Buckets up to this many distinct fingerprints are compared in place; larger ones take the variants' way.
BUCKET_ROWS = 4096
#: Groups up to this size are compared pair by pair.
_PAIRWISE = 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text: A-Z in lower case, words between ASCII white space, XXH64 with seed 42."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], stops[:-1]])
    digest = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), (stops[width - 1 :] - 1).tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_535):  # four counters of 16 bits in a sum
        part = hashes[at : at + 65_535]
        for bit in range(16):
            total = int(((part >> np.uint64(bit)) & np.uint64(0x0001000100010001)).sum())
            for lane in range(4):
                ones[bit + 16 * lane] += total >> 16 * lane & 0xFFFF
    return sum(1 << i for i in range(64) if 2 * int(ones[i]) > n)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """One mask a table; any ``radius`` positions are all left out of at least one."""
    size = (1 << radius + 1) - 1
    code = [1 + i % size for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (code[i] & v).bit_count() & 1) for v in range(1, size + 1)]


def fingerprints(df: DataFrame, shingle: int = 3, key_col: str = "_key", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: key and fingerprint (the unsigned value as a signed long)."""

    def rows(keys: list, texts: list) -> dict:
        return {"key": keys, "fp": [_signed(fingerprint(t, shingle)) for t in texts]}

    return arrow_rows(df.select(key_col, F.col(text_col).cast("binary")), rows, "key long, fp long")


def _spanning(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one bucket, as index pairs."""
    label, out = np.arange(len(fp)), []
    for i in range(1, len(fp)):
        near = np.flatnonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= radius)
        if len(near):
            roots, first = np.unique(label[near], return_index=True)
            out += [(i, int(near[k])) for k in first]
            if len(roots) > 1:
                label[:i][np.isin(label[:i], roots)] = roots[0]
            label[i] = roots[0]
    return out


def _links(bucket: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the buckets of rows sorted by bucket."""
    fp = fp.view(np.uint64)  # numpy counts the bits of a signed number's absolute value
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    sizes = np.diff(edges)
    large = sizes > _PAIRWISE
    a, b = [], []
    small = np.repeat(~large, sizes)
    for k in range(1, _PAIRWISE):
        at = np.flatnonzero((bucket[k:] == bucket[:-k]) & small[k:])
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + k]) <= radius]
        a.append(node[at])
        b.append(node[at + k])
    for start, size in zip(edges[:-1][large], sizes[large], strict=True):
        pairs = np.array(_spanning(fp[start : start + size], radius), np.int64).reshape(-1, 2) + start
        a.append(node[pairs[:, 0]])
        b.append(node[pairs[:, 1]])
    return (np.concatenate(a), np.concatenate(b)) if a else (node[:0], node[:0])


def _bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    """``rows``: bucket, fp, node. Streams the sorted buckets of a partition, holding one unfinished bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        held = None
        for batch in batches:
            now = np.stack([batch.column(i).to_numpy() for i in range(3)])
            now = now if held is None else np.concatenate([held, now], axis=1)
            cut = int(np.searchsorted(now[0], now[0, -1])) if now.shape[1] else 0
            held = now[:, cut:]
            if cut:
                a, b = _links(now[0, :cut], now[1, :cut], now[2, :cut], radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        if held is not None and held.shape[1]:
            a, b = _links(*held, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.repartition("bucket").sortWithinPartitions("bucket", "fp").mapInArrow(run, "a long, b long")


def _variant_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links among ``rows`` (fp, node) through variants: ``radius`` flips are split between the two ends."""
    far = radius - radius // 2
    flips = [(0, 0), *((n, sum(1 << i for i in c)) for n in range(1, far + 1) for c in combinations(range(64), n))]
    shifts = F.lit([_signed(m) for _, m in flips])
    steps = F.lit([n for n, _ in flips])
    each = rows.select("node", "fp", F.posexplode(shifts).alias("i", "m")).select("node", F.col("fp").bitwiseXOR(F.col("m")).alias("z"), F.element_at(steps, F.col("i") + 1).alias("n"))
    hubs = each.filter(F.col("n") <= radius // 2).groupBy("z").agg(F.min("node").alias("hub"))
    return each.join(hubs, "z").filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def near_links(nodes: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``nodes`` (fp distinct, node) to links (a, b) that connect what chains of links within ``radius`` connect."""
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("m")) for k, m in enumerate(covering_masks(radius))])
    rows = nodes.select("fp", "node", F.explode(tables).alias("k")).select(F.xxhash64("k.t", "k.m").alias("bucket"), "fp", "node")
    hot = materialise(rows.groupBy("bucket").count().filter(F.col("count") > bucket_rows).select("bucket"), "hot")
    if not hot.limit(1).count():
        return _bucket_links(rows, radius)
    crowded = materialise(rows.join(hot, "bucket", "left_semi").select("fp", "node").distinct(), "crowded")
    return _bucket_links(rows.join(hot, "bucket", "left_anti"), radius).unionByName(_variant_links(crowded, radius))


def near_groups(df: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint, component_id (the smallest id reachable), and whether the row is that document."""
    spark = df.sparkSession
    keyed, same = with_key(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    prints = materialise(fingerprints(keyed, shingle), "prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("key").alias("node")), "nodes")
    names = components(near_links(nodes, radius, bucket_rows))
    labelled = nodes.join(names, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    out = prints.join(materialise(labelled, "labelled"), "fp").select("key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component")
    release_shuffles(spark)
    if same:
        return out.select(F.col("key").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"), (F.col("key") == F.col("component")).alias("kept"))
    ids = keyed.select(F.col("_key").alias("key"), "doc_id")
    named = materialise(out.join(ids, "key"), "named")
    first = ids.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
    return named.join(first, "component").select("doc_id", "fingerprint", "component_id", (F.col("key") == F.col("component")).alias("kept"))


def drop_near_duplicates(df: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one document of each group, that of the smallest id; columns as given."""
    inner, (ident, text) = numbered_columns(df, id_col, text_col)
    keyed, _ = with_key(inner, ident, text)
    groups = near_groups(keyed.select("_key", text), radius, shingle, "_key", text)
    gone = materialise(groups.filter("NOT kept").select(F.col("doc_id").alias("_key")), "gone")
    return keyed.join(gone, "_key", "left_anti").select(inner.columns).toDF(*df.columns)
