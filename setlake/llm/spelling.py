"""Spelling variants: words within one edit of each other, grouped under the more frequent form.

One inserted, deleted or replaced letter leaves the first or the last half of a word intact. So words that share a first half lie side by
side in a sorted dictionary, and words that share a last half in a dictionary of the reversed words; each is a block that a scan over a
sorted range compares. A word of a length stands in the blocks of its own length, and as the longer one in those of a length
less. A block of more than ``BLOCK`` words is subdivided by the same rule: its words agree in a prefix and a suffix, and one edit leaves a
half of what lies between intact, so they fall into smaller blocks with a longer prefix or a longer suffix. A block whose
words agree in all but one letter can't be subdivided; it is as large as the alphabet allows. A pair is told by one block alone: that with the
longer prefix, where both halves agree.

Words are counted in the tasks and summed by Spark; forms are followed by pointer doubling. Defined cases: a null text has no word;
a null id counts as an empty string; rows that share an id or are equal count each; texts and words of any length are whole; of near words with
equal counts the smallest in code-point order counts; an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlake.llm.common import begin_work, drop_scratch, materialise

#: Words that a block may have before it is subdivided.
BLOCK = 256
#: Distinct words that a task holds before it passes on their counts.
HELD = 200_000
#: Elements of a matrix of words that are compared at once.
CELLS = 1 << 21
#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, once A-Z are lower-cased.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_NO_LIMIT = 1 << 30


def thinned(run: bytes, prefix: int, every: int) -> bytes:
    """``run``, without one code point if ``every`` divides its checksum, which starts from ``prefix``."""
    h = zlib.crc32(run, prefix)
    if h % every:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(df: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int, thin: int) -> DataFrame:
    """Rows word, n of words of at least ``min_length`` letters and ``min_count`` occurrences. ``thin`` > 0 deletes a letter of one in so many (id, run)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [(w, n) for w, n in held.items() if len(w) >= min_length and len(w) - w.count(b"\xc3") >= min_length]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.binary()).cast(pa.string()), pa.array([n for _, n in words], pa.int64())], names=["word", "n"])

        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                runs = Counter(_RUN.findall((text or b"").translate(_LOWER)))
                if thin:
                    prefix = zlib.crc32(f"{ident}:".encode())
                    for run, n in runs.items():
                        if len(run) >= min_length:
                            held[thinned(run, prefix, thin)] += n
                else:
                    held.update(runs)
                if len(held) > HELD:
                    yield out()
        yield out()

    found = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)).mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


_KEY = ["cls", "a", "b", "limit", "head", "tail"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Blocks of words of ``cls`` letters, or one more, that share the first ``a`` and the last ``b``."""
    return rows.select("cls", "a", "b", "limit", F.substring("word", F.lit(1), F.col("a")).alias("head"), F.when(F.col("b") > 0, F.right("word", F.col("b"))).otherwise("").alias("tail"), "word", "n")


def _rest() -> Column:
    return F.col("cls") - F.col("a") - F.col("b")


def _subdivided(rows: DataFrame) -> DataFrame:
    """Each row in the block with a longer prefix and in that with a longer suffix. Pairs of the latter must share less than the former's prefix, so as to be told once."""
    half = F.floor(_rest() / 2).cast("int")
    left = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("limit").alias("limit"))
    right = F.struct(F.col("a").alias("a"), (F.col("b") + half).alias("b"), F.least(F.col("limit"), F.col("a") + half).alias("limit"))
    each = rows.select("cls", "word", "n", F.explode(F.array(left, right)).alias("x")).select("cls", "x.*", "word", "n")
    return _keyed(each.filter(F.col("a") < F.col("limit")))


def _letters(words: list[str]) -> np.ndarray:
    """Code points of words, one row each, padded with zeros."""
    found = np.array(words)
    return found.view(np.uint32).reshape(len(words), -1)


def _common(letters: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """How many first code points the words of each pair share; they differ somewhere."""
    return (letters[p] != letters[q]).argmax(axis=1)


def _compared(numbers: np.ndarray, words: list[str], edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within one edit among rows of whole blocks; ``numbers`` are cls, a, b, limit of each row, ``edges`` where blocks start and end."""
    cls, a, b, limit = numbers
    length = np.fromiter(map(len, words), np.int64, len(words))
    block = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    forward, backward = _letters(words), _letters([w[::-1] for w in words])
    out = [(np.zeros(0, np.int64),) * 2]
    step = max(1, CELLS // forward.shape[1])
    for k in range(1, int(np.diff(edges).max(initial=1))):
        pairs = np.flatnonzero((block[k:] == block[:-k]) & ((length[k:] == cls[k:]) | (length[:-k] == cls[:-k])))
        for at in range(0, len(pairs), step):
            p = pairs[at : at + step]
            q = p + k
            first, last = _common(forward, p, q), _common(backward, p, q)
            near = (first + last >= np.maximum(length[p], length[q]) - 1) & (first >= a[p]) & (last >= b[p]) & (first < limit[p])
            out.append((p[near], q[near]))
    p, q = (np.concatenate(x) for x in zip(*out, strict=True))
    return p, q


def _scanned(blocks: DataFrame) -> DataFrame:
    """Near pairs of blocks, both ways round: word, near, near_n. Holds one unfinished block and the batch behind it."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        held: pa.Table | None = None
        for batch in chain(batches, [None]):
            if batch is not None:
                now = pa.Table.from_batches([batch])
                held = now if held is None else pa.concat_tables([held, now])
            if held is None or not held.num_rows:
                continue
            block, cls = (held.column(i).to_numpy() for i in (0, 1))
            edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
            edges = edges if batch is None else edges[:-1]
            # stretches of words of about one length, so that a long one does not widen the others' matrix
            cuts = np.flatnonzero(np.concatenate([[True], cls[edges[1:-1]] != cls[edges[:-2]], [True]])) if len(edges) > 1 else []
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                width = int(cls[edges[start]]) + 1
                while start < stop:
                    to = max(start + 1, int(np.searchsorted(edges, edges[start] + CELLS // width, side="right")) - 1)
                    to = min(to, stop)
                    part = held.slice(edges[start], edges[to] - edges[start])
                    words, n = part.column(5).to_pylist(), part.column(6).to_numpy()
                    p, q = _compared(np.stack([part.column(i).to_numpy() for i in (1, 2, 3, 4)]).astype(np.int64), words, edges[start : to + 1] - edges[start])
                    one, two = np.concatenate([p, q]), np.concatenate([q, p])
                    yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in one], pa.string()), pa.array([words[i] for i in two], pa.string()), pa.array(n[two], pa.int64())], names=["word", "near", "near_n"])
                    start = to
            held = held.slice(edges[-1])

    ranged = blocks.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, "word")
    return ranged.select(F.xxhash64(*_KEY).alias("block"), "cls", "a", "b", "limit", "word", "n").mapInArrow(scan, "word string, near string, near_n long")


def near_words(words: DataFrame) -> DataFrame:
    """``words`` (word, n; distinct) to word, near, near_n for each two within one edit, both ways round."""
    spark = words.sparkSession
    long = F.char_length("word")
    classes = words.select(F.explode(F.array(long, long - 1)).alias("cls"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(_NO_LIMIT).alias("limit"), "word", "n").filter("cls > 0")
    rows, out, before = _subdivided(classes), None, []
    while rows is not None:
        # a block needs a word of its class and another one
        sizes = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.char_length("word") == F.col("cls")).alias("own")).filter("total > 1 AND own > 0").drop("own")
        sized = materialise(rows.join(sizes, _KEY), "blocks")
        drop_scratch(spark, *before)
        large = (F.col("total") > BLOCK) & (_rest() > 1)
        found = materialise(_scanned(sized.filter(~large)), "near")
        out = found if out is None else out.unionByName(found)
        more = sized.filter(large)
        rows, before = _subdivided(more) if more.limit(1).count() else None, [sized]
    drop_scratch(spark, *before)
    return out


def followed(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) to word, root: the last form of the chain. Each round doubles the steps taken; chains are short, as counts grow along them."""
    spark = forms.sparkSession
    roots = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = materialise(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        drop_scratch(spark, roots)
        roots = new
        if not roots.filter("moved").limit(1).count():
            return roots.select("word", "root")


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 6, min_count: int = 5, ratio: int = 5, thin: int = 0) -> DataFrame:
    """One row per word: word, form (its most frequent near word, if that is ``ratio`` times as frequent), root, n, n_near, form_n."""
    words = materialise(word_counts(df, id_col, text_col, min_length, min_count, thin), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    taken = -F.col("best.n") >= F.col("n") * ratio
    formed = words.join(near, "word", "left").select("word", F.when(taken, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, -F.col("best.n")).alias("form_n"))
    formed = materialise(formed, "forms")
    roots = followed(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
