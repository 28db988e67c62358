"""Byte-level BPE encoding and decoding by DuckDB queries inside each partition.

A text is cut by a pattern into words. Words that a worker has not met yet become rows (word,
position, token), one a byte; a recursive query joins neighbouring tokens to the merge table and
contracts each word's leftmost pair of smallest rank, until no word has a pair left. An ordered
aggregation then gives each word's ids. Decoding joins the ids to the vocabulary and aggregates the
bytes in order. The merge table holds every pair of tokens whose bytes together are a token.

Words of more than ``LONG`` bytes go through the same query in overlapping chunks. A sequence of tokens
is the encoding of its bytes if every two neighbours in it are the encoding of theirs: the first merge across a
border would also be made between these two alone. So two chunks that have a token at the same
place in common join there, as each neighbourhood has been seen by one of them. Chunks without such a token
become one. One of over ``LONG`` bytes contracts all equal pairs of smallest rank in one step
where that is certain to give the same ids (no merge that contains the new token ranks before it).

Each worker process has one in-memory database on one thread, without a spill folder; what its queries
hold is bounded by the rows of all their steps. Distinct words are contracted once and looked up when a worker meets them again.

Defined cases: null and empty texts have no ids and decode to nothing; very long texts and words are encoded whole; of equal
pairs the leftmost goes first; repeated rows and ids are separate rows of the result; an empty table gives an empty
result; only the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from setlake.llm.common import arrow_rows, worker_cache

#: Words that a worker keeps; longer ones are not kept.
CACHE_ENTRIES, CACHE_CHARS = 600_000, 48
#: Bytes from which a word counts as long, length and distance of its chunks, rows of all steps of a query, steps before rows are renewed, ids decoded in one group.
LONG, CHUNK, APART, QUERY_ROWS, STEPS, DECODE_IDS = 128, 96, 64, 1 << 21, 64, 1 << 16

_SHORT = """
WITH RECURSIVE steps AS (
    SELECT w, p, t, 0 AS r FROM start
    UNION ALL (
    WITH a AS (SELECT w, p, t, lead(t) OVER o AS tn, lead(w) OVER o AS wn, lead(p) OVER o AS pn FROM steps WINDOW o AS (ORDER BY p)),
    b AS (SELECT a.w, a.p, a.pn, m.id FROM a JOIN merges m ON m.l = a.t AND m.r = a.tn WHERE a.w = a.wn),
    c AS (SELECT w, min(id * 16777216::BIGINT + p) AS best, arg_min(pn, id * 16777216::BIGINT + p) AS eaten FROM b GROUP BY w)
    SELECT s.w, s.p, CASE WHEN best & 16777215 = s.p THEN best >> 24 ELSE s.t END, s.r + 1 FROM steps s JOIN c USING (w) WHERE s.p <> c.eaten))
SELECT list(t ORDER BY p) AS ids FROM steps JOIN (SELECT w, max(r) AS r FROM steps GROUP BY w) USING (w, r) GROUP BY w ORDER BY w"""
_WHOLE = f"""
WITH RECURSIVE steps AS (
    SELECT w, p, t, 0 AS r FROM start
    UNION ALL (
    WITH a AS (SELECT w, p, t, r, lead(t) OVER (PARTITION BY w ORDER BY p) AS tn FROM steps WHERE r < {STEPS}),
    b AS (SELECT a.*, m.id FROM a LEFT JOIN merges m ON m.l = a.t AND m.r = a.tn),
    c AS (SELECT b.*, min(id) OVER (PARTITION BY w) AS low FROM b),
    d AS (SELECT c.*, id IS NOT DISTINCT FROM low AS hit FROM c WHERE low IS NOT NULL),
    f AS (SELECT d.*, count(*) FILTER (NOT hit) OVER (PARTITION BY w ORDER BY p) AS run,
                 min(p) FILTER (hit) OVER (PARTITION BY w) AS leftmost FROM d),
    g AS (SELECT f.*, hit AND row_number() OVER (PARTITION BY w, run, hit ORDER BY p) % 2 = 1
                 AND (p = leftmost OR low NOT IN (SELECT id FROM unsafe)) AS taken FROM f),
    e AS (SELECT g.*, lag(taken, 1, false) OVER (PARTITION BY w ORDER BY p) AS eaten FROM g)
    SELECT w, p, CASE WHEN taken THEN id ELSE t END, r + 1 FROM e WHERE NOT eaten))
SELECT w, p, t FROM steps QUALIFY r = max(r) OVER (PARTITION BY w)"""


class WordIds:
    """The ids of words, as little-endian unsigned 32-bit integers.

    Keeps what was used lately, in two generations of at most half of ``size`` words and a batch.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], size: int | None = None) -> None:
        self._encode, self._half = encode, (size or CACHE_ENTRIES) // 2
        self._now: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def join(self, split: list[list[str]]) -> list[bytes]:
        """The ids of each list of words behind each other."""
        if len(self._now) > self._half:
            self._before, self._now = self._now, {}
        now = self._now
        new = set().union(*split).difference(now)
        for word in self._before.keys() & new:
            now[word] = self._before[word]
        new = [w for w in new if w not in now]
        now.update(zip(new, self._encode(new), strict=True))
        out = [b"".join(map(now.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > CACHE_CHARS:
                del now[word]
        return out


Span = tuple[int, int, int]  # word, first byte, end


class BytePairs:
    """The ranks of a ``tiktoken`` file and a pattern, in a database of their own."""

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        merges = [(self.ranks[a], self.ranks[b], i) for t, i in self.ranks.items() for k in range(1, len(t)) if (a := t[:k]) in self.ranks and (b := t[k:]) in self.ranks]
        left, right, made = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        self.db = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": "", "memory_limit": "400MB"})
        tables = {
            "merges": pa.table({"l": left, "r": right, "id": made}),
            "vocabulary": pa.table({"id": np.array(list(self.ranks.values()), np.int64), "hex": [t.hex() for t in self.ranks]}),
            "unsafe": pa.table({"id": np.unique(np.concatenate([left[made < left], right[made < right]]))}),
        }
        for name, table in tables.items():
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS FROM given")
            self.db.unregister("given")
        self.sizes = np.zeros(max(self.ranks.values()) + 1, np.int64)
        self.sizes[list(self.ranks.values())] = [len(t) for t in self.ranks]
        self.decimal = [str(i) for i in range(len(self.sizes))]
        self.words = WordIds(self._learn)

    def _contract(self, words: list[bytes], long: bool) -> list[bytes]:
        """The ids of each word, as of :class:`WordIds`. Positions count through all words, so that their order is that of the rows."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        rows = pa.table({"w": np.repeat(np.arange(len(words)), sizes), "p": np.arange(sizes.sum()), "t": self.byte[np.frombuffer(b"".join(words), np.uint8)]})
        left = rows.num_rows + 1
        while long and rows.num_rows < left:  # each query ends after STEPS steps, so that it doesn't hold all of them
            left = rows.num_rows
            rows = self._query(_WHOLE, "start", rows)
        out = (self._query("SELECT list(t ORDER BY p) AS ids FROM done GROUP BY w ORDER BY w", "done", rows) if long else self._query(_SHORT, "start", rows))["ids"].combine_chunks()
        ids, ends = out.values.to_numpy().astype("<u4").tobytes(), out.offsets.to_numpy() * 4
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _query(self, sql: str, name: str, table: pa.Table) -> pa.Table:
        self.db.register(name, table)
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return out

    def _contracted(self, words: list[bytes]) -> list[bytes]:
        """The ids of words, of a bounded number of steps' rows in a query."""
        found: dict[bytes, bytes] = {b"": b""}
        for long in (False, True):
            pending, rows = [], 0
            for word in {w: None for w in words if w and (len(w) > LONG) == long}:
                pending.append(word)
                rows += len(word) * (16 if long else len(word))
                if rows >= QUERY_ROWS:
                    found.update(zip(pending, self._contract(pending, long), strict=True))
                    pending, rows = [], 0
            if pending:
                found.update(zip(pending, self._contract(pending, long), strict=True))
        return [found[w] for w in words]

    def _joint(self, a: Span, b: Span, found: dict[Span, np.ndarray], least: int) -> int:
        """Where the first token from ``least`` on starts that two overlapping chunks share, or -1."""
        place = []
        for span in (a, b):
            ends = span[1] + np.cumsum(self.sizes[found[span]])
            place.append(ends - self.sizes[found[span]] << 32 | ends)
        shared = np.intersect1d(*place, assume_unique=True) >> 32
        shared = shared[shared >= least]
        return int(shared[0]) if len(shared) else -1

    def _joined(self, chunks: list[Span], size: int, found: dict[Span, np.ndarray]) -> tuple[list[Span], list[int], bool]:
        """Chunks of a word and their joints, and whether all of them met; where they didn't, the first of two grows, and a second one that lies in it goes."""
        kept, joints, whole = chunks[:1], [], True
        for chunk in chunks[1:]:
            w, start, end = kept[-1]
            at = self._joint(kept[-1], chunk, found, joints[-1] if joints else 0)
            if at >= 0:
                joints.append(at)
            elif end >= chunk[2]:
                continue
            else:
                kept[-1] = (w, start, max(min(size, 2 * end - start), end))
                joints.append(max(joints[-1:], default=0))
                whole = False
            kept.append(chunk)
        return kept, joints, whole

    def _by_chunks(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of long words."""
        chunks = [[(w, at, min(at + CHUNK, len(word))) for at in range(0, len(word) - CHUNK + APART, APART)] for w, word in enumerate(words)]
        found: dict[Span, np.ndarray] = {}
        out: dict[int, np.ndarray] = {}
        while left := [w for w in range(len(words)) if w not in out]:
            new = [s for w in left for s in chunks[w] if s not in found]
            ids = self._contracted([words[w][a:b] for w, a, b in new])
            found.update((span, np.frombuffer(x, "<u4")) for span, x in zip(new, ids, strict=True))
            for w in left:
                chunks[w], joints, whole = self._joined(chunks[w], len(words[w]), found)
                if whole:
                    parts = []
                    for chunk, low, high in zip(chunks[w], [-1, *joints], [*joints, len(words[w])], strict=True):  # a shared token is taken from the first chunk
                        starts = chunk[1] + np.cumsum(self.sizes[found[chunk]]) - self.sizes[found[chunk]]
                        parts.append(found[chunk][(starts > low) & (starts <= high)])
                    out[w] = np.concatenate(parts)
        return [out[w] for w in range(len(words))]

    def _learn(self, words: list[str]) -> list[bytes]:
        """The ids of words that aren't known yet."""
        texts = [w.encode() for w in words]
        long = [i for i, t in enumerate(texts) if len(t) > LONG]
        out = self._contracted([t if len(t) <= LONG else b"" for t in texts])
        for i, ids in zip(long, self._by_chunks([texts[i] for i in long]), strict=True):
            out[i] = ids.tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: empty) as little-endian unsigned 32-bit integers."""
        return self.words.join([self.pattern.findall(t or "") for t in texts])

    def decode(self, documents: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        sizes = np.array([len(d) for d in documents], np.int64)
        if not sizes.sum():
            return [b""] * len(documents)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = pa.table({"d": np.repeat(np.arange(len(documents)), sizes), "p": place, "id": np.concatenate(documents).astype(np.int64)})
        rows = self._query(f"SELECT d, p // {DECODE_IDS} AS k, string_agg(hex, '' ORDER BY p) AS h FROM ids JOIN vocabulary USING (id) GROUP BY ALL ORDER BY d, k", "ids", ids)
        out = [[] for _ in documents]
        for d, h in zip(rows["d"].to_pylist(), rows["h"].to_pylist(), strict=True):
            out[d].append(bytes.fromhex(h))
        return [b"".join(x) for x in out]


@worker_cache
def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One a worker process."""
    return BytePairs(path, pattern)


def encode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id and ids (array of int)."""

    def rows(keys: list, texts: list) -> dict:
        return {"doc_id": keys, "ids": [np.frombuffer(x, "<i4") for x in byte_pairs(ranks, pattern).encode(texts)]}

    return arrow_rows(df.select(id_col, text_col), rows, f"doc_id {dict(df.dtypes)[id_col]}, ids array<int>")


def decode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``df``: doc_id and the bytes that its ids stand for."""

    def rows(keys: list, ids: list) -> dict:
        return {"doc_id": keys, "data": byte_pairs(ranks, pattern).decode([np.array(x or [], np.int64) for x in ids])}

    return arrow_rows(df.select(id_col, ids_col), rows, f"doc_id {dict(df.dtypes)[id_col]}, data binary")


def round_trip(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def rows(keys: list, texts: list) -> dict:
        pairs = byte_pairs(ranks, pattern)
        ids = [np.frombuffer(x, "<u4") for x in pairs.encode(texts)]
        return {
            "doc_id": keys,
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [hashlib.sha256(" ".join(map(pairs.decimal.__getitem__, x.tolist())).encode()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in pairs.decode(ids)],
        }

    return arrow_rows(df.select(id_col, text_col), rows, f"doc_id {dict(df.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string")
