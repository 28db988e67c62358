"""Ways and relations as OpenStreetMap PBF files, one a partition: what the ``osmpbf`` source reads, without coordinates."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of a block.
BLOCK_ROWS = 8000


def _number(n: int) -> bytes:
    """An unsigned varint; negative numbers as 64-bit two's complement."""
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


_SMALL = [_number(n) for n in range(1 << 14)]


def _short(n: int) -> bytes:
    return _SMALL[n] if 0 <= n < 1 << 14 else _number(n)


def _entry(number: int, value: int | bytes) -> bytes:
    if isinstance(value, int):
        return _short(number << 3) + _short(value)
    return _short(number << 3 | 2) + _short(len(value)) + value


def _blob(kind: bytes, message: bytes) -> bytes:
    body = _entry(2, len(message)) + _entry(3, zlib.compress(message))
    head = _entry(1, kind) + _entry(3, len(body))
    return len(head).to_bytes(4, "big") + head + body


def _varints(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Unsigned varints behind each other, and where each begins and the last ends."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        sizes += values >= np.uint64(1 << bits)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    nth = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
    out = (np.repeat(values, sizes) >> (7 * nth).astype(np.uint64)).astype(np.uint8) & 0x7F
    out |= (nth < np.repeat(sizes, sizes) - 1).astype(np.uint8) << 7
    return out.tobytes(), ends


def _steps(lists: list[list[int]]) -> list[bytes]:
    """Each list as packed zigzag differences, the first one's from zero."""
    sizes = np.array([len(x) for x in lists], np.int64)
    values = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
    steps = np.diff(values, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[first] = values[first]
    data, ends = _varints((steps << 1) ^ (steps >> 63))
    at = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    return [data[i:j] for i, j in zip(at, at[1:], strict=False)]


def _block(rows: list[tuple[str, int, list[int] | None, list[dict] | None]]) -> bytes:
    strings: dict[str, int] = {"": 0}
    group = []
    for (kind, ident, _, tags), steps in zip(rows, _steps([r[2] or [] if r[0] == "way" else [] for r in rows]), strict=True):
        at = [strings.setdefault(x or "", len(strings)) for t in tags or () for x in (t["k"], t["v"])]
        element = _entry(1, ident) + (_entry(2, b"".join(map(_short, at[::2]))) + _entry(3, b"".join(map(_short, at[1::2]))) if at else _entry(2, b"") + _entry(3, b""))
        group.append(_entry(3, element + _entry(8, steps)) if kind == "way" else _entry(4, element))
    return _entry(1, b"".join(_entry(1, s.encode()) for s in strings)) + _entry(2, b"".join(group))


def write_pbf(df: DataFrame, folder: Path) -> list[Path]:
    """Write ``df`` (osm_type ``way`` or ``relation``, osm_id, refs, tags as (k, v)) to ``folder``; the files, one a partition with rows.

    A file is written under the name of the attempt and then renamed, so that a task that runs twice leaves one. Null references
    and tags are none; rows of other types fail the task.
    """
    folder.mkdir(parents=True, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, path = TaskContext.get(), None
        fresh = folder / f".{context.partitionId()}.{context.taskAttemptId()}"
        with fresh.open("wb") as out:
            out.write(_blob(b"OSMHeader", _entry(4, b"OsmSchema-V0.6")))
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    rows = list(zip(*(c.to_pylist() for c in batch.slice(at, BLOCK_ROWS).columns), strict=True))
                    if odd := {r[0] for r in rows} - {"way", "relation"}:
                        raise ValueError(f"no way or relation: {sorted(map(str, odd))}")
                    out.write(_blob(b"OSMData", _block(rows)))
                    path = folder / f"part-{context.partitionId():05d}.osm.pbf"
        if path is None:
            fresh.unlink()
            return
        fresh.replace(path)
        yield pa.RecordBatch.from_pydict({"path": [str(path)]})

    columns = [F.col("osm_type"), F.col("osm_id").cast("long"), F.col("refs").cast("array<bigint>"), F.col("tags").cast("array<struct<k:string,v:string>>")]
    return sorted(Path(r.path) for r in df.select(*columns).mapInArrow(run, "path string").collect())  # a path a file
