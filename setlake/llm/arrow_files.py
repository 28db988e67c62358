"""Token ids in Arrow IPC files of fixed-size lists, for zero-copy random access.

Documents in ascending id order form one stream of ids, each document followed by an end id. The
stream is cut into sequences of equal length; a file holds those of one range of ids, as record
batches with two fixed-size-list columns: ``ids`` (16 bits where the vocabulary allows, else 32) and
``mask`` (true for ids, false for the padding of a file's last sequence). Nothing is compressed, so a
memory-mapped reader finds sequence *i* at a computed place. Beside each file lies an index of its
documents (id, first id, number of ids).

Files are written under a name of the attempt and then moved, so a task that runs twice leaves one
file. They go to the given folder on any file system that ``pyarrow.fs`` opens by URI.

Defined cases: null and empty texts are documents of one id; a very long text runs over as many sequences and record batches as it
needs; null ids come first; rows that share an id are documents of their own, in an order that their texts alone decide;
an empty table makes no file; only the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlake.llm.common import begin_work, scratch
from setlake.llm.tokens import encoder, vocabulary_size

#: Sequences in a record batch.
BATCH_SEQUENCES = 256
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.removeprefix("file:"))


def _reader(uri: str) -> pa.ipc.RecordBatchFileReader:
    """Memory-mapped where the file system is local."""
    from pyarrow import fs

    system, path = _open(uri)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path))


class _Writer:
    """One shard: buffers ids until a record batch is full."""

    def __init__(self, folder: str, shard: int, attempt: int, length: int, dtype: str) -> None:
        self.length, self.dtype, self.tokens, self.docs = length, np.dtype(dtype), 0, 0
        self.system, path = _open(folder)
        self.names = {k: (f"{path}/.{k}-{shard:06d}.{attempt}", f"{path}/{k}-{shard:06d}.arrow") for k in ("ids", "docs")}
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sinks = {k: self.system.open_output_stream(v[0]) for k, v in self.names.items()}
        self.ids = pa.ipc.new_file(self.sinks["ids"], self.schema)
        self.index = pa.ipc.new_file(self.sinks["docs"], _INDEX)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, docs: list, tokens: list[bytes]) -> None:
        arrays = [np.frombuffer(t, dtype="<u4") for t in tokens]
        sizes = np.array([len(a) for a in arrays], dtype=np.int64)
        starts = self.tokens + np.cumsum(sizes) - sizes
        self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts), pa.array(sizes)], schema=_INDEX))
        self.held += [a.astype(self.dtype) for a in arrays]
        self.n_held += int(sizes.sum())
        self.tokens += int(sizes.sum())
        self.docs += len(docs)
        if self.n_held >= BATCH_SEQUENCES * self.length:
            self._flush(self.n_held // (BATCH_SEQUENCES * self.length) * BATCH_SEQUENCES * self.length)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        for at in range(0, n, BATCH_SEQUENCES * self.length):
            part = flat[at : min(n, at + BATCH_SEQUENCES * self.length)]
            mask = np.ones(-(-len(part) // self.length) * self.length, dtype=bool)
            mask[len(part) :] = False
            part = np.concatenate([part, np.zeros(len(mask) - len(part), self.dtype)])
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, mask)]
            self.ids.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.held, self.n_held = [flat[n:]], len(flat) - n

    def close(self) -> None:
        self._flush(self.n_held)
        self.ids.close()
        self.index.close()
        for k, sink in self.sinks.items():
            sink.close()
            self.system.move(*self.names[k])


def write_tokens(df: DataFrame, folder: str, tokenizer: str, length: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; returns (and has computed) one row per file: shard, n_docs, n_tokens, start.

    ``start`` is the number of ids in all files before. It needs the totals of every file, a few
    numbers a file, which the driver sums.
    """
    from pyspark import TaskContext

    dtype = "uint16" if vocabulary_size(tokenizer) <= 1 << 16 and end_id < 1 << 16 else "uint32"
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(__name__)
        context, writer = TaskContext.get(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                docs, texts = (c.to_pylist() for c in batch.slice(at, 256).columns)
                writer = writer or _Writer(folder, context.partitionId(), context.taskAttemptId(), length, dtype)
                writer.add(docs, [t + end for t in encoder(tokenizer)(texts)])
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [context.partitionId()], "n_docs": [writer.docs], "n_tokens": [writer.tokens]})

    ids = F.col(id_col).cast("long")
    order = [F.col("i").asc_nulls_first(), F.xxhash64("t")]  # the hash deals out the rows of one id
    ordered = df.select(ids.alias("i"), F.col(text_col).alias("t")).repartitionByRange(*order).sortWithinPartitions(*order, F.col("t").asc_nulls_first())
    shards, start = [], 0
    for r in sorted(ordered.mapInArrow(run, "shard long, n_docs long, n_tokens long").collect()):
        shards.append((*r, start))
        start += r["n_tokens"]
    return df.sparkSession.createDataFrame(shards, "shard long, n_docs long, n_tokens long, start long")


def read_range(reader: pa.ipc.RecordBatchFileReader, length: int, start: int, n: int) -> Iterator[np.ndarray]:
    """The ids [start, start + n) of a file, as views of its record batches."""
    per = BATCH_SEQUENCES * length
    while n > 0:
        view = reader.get_batch(start // per).column(0).flatten().to_numpy()[start % per : start % per + n]
        yield view
        start, n = start + len(view), n - len(view)


def read_documents(spark: SparkSession, folder: str, shards: DataFrame, length: int = 2048) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist(), strict=True):
                ids, index = (_reader(f"{folder}/{k}-{shard:06d}.arrow") for k in ("ids", "docs"))
                for i in range(index.num_record_batches):
                    docs = index.get_batch(i)
                    crcs = []
                    for start, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist(), strict=True):
                        crc = 0
                        for view in read_range(ids, length, start, n):
                            crc = zlib.crc32(view.astype("<u4").tobytes(), crc)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(docs.column("start").to_numpy() + base), docs.column("n_tokens"), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, min(spark.sparkContext.defaultParallelism * 4, shards.count()))
    return shards.select("shard", "start").repartition(files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(df: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``df`` and read the files back."""
    folder = folder or scratch(df.sparkSession, "tokens")
    return read_documents(df.sparkSession, folder, write_tokens(df, folder, tokenizer, length, end_id), length)
