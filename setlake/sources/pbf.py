"""OpenStreetMap PBF as a Spark data source, without geometry.

``register(spark)`` and then ``spark.read.format("osmpbf").load(path)``. Options: ``path`` or ``paths`` (a JSON list; mounted, or URIs
of a store that Arrow opens), ``mode`` (``identities``: keys of closed ways and area relations; ``elements``: all ways and relations
with their references and tags), ``ring_rule``, and ``split_bytes``. A schema of some of the columns reads no more than these, and
one with references or tags asks for elements. Filters on ``osm_type`` and ``source`` are taken over: elements of other types stay undecoded, other files
unopened. Nodes are skipped unread. Rows leave as Arrow batches.

Planning cuts files into ranges of bytes by their size alone and opens none; ``split_bytes`` is the least size of a range, and with much to read ranges grow
up to ``SPLIT_BYTES``. A task finds the first blob of its range itself (:func:`first_blob`), so
one large file is read by many tasks and any cuts give the same rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from setlake.functions.predicates import RELATION_TYPES, RING_RULES, Identity

#: Size limits of the format, which tell a damaged file from a large one.
MAX_HEADER, MAX_BLOB = 64 * 1024, 32 * 1024 * 1024
#: Required features that this reader understands.
FEATURES = {b"OsmSchema-V0.6", b"DenseNodes", b"HistoricalInformation"}
BATCH_ROWS, SPLIT_BYTES = 65_536, 128 << 20
#: Stretches that small splits are widened to, up to SPLIT_BYTES each, as a task costs more than a small stretch does.
MANY = 256
_AREAS = {t.encode() for t in RELATION_TYPES}
#: Field numbers of ways and relations in a group.
KINDS = {"way": 3, "relation": 4}
#: Where a blob may start: a length of at most MAX_HEADER, then the first field of its header.
_START = re.compile(rb"\x00(?:\x00..|\x01\x00\x00)[\x0a\x12\x18]", re.DOTALL)

IDENTITIES = T.StructType().add("source", "string").add("osm_type", "string").add("osm_id", "long")
ELEMENTS = T.StructType([*IDENTITIES.fields]).add("refs", T.ArrayType(T.LongType())).add("tags", T.ArrayType(T.StructType().add("k", "string").add("v", "string")))


class PBFReadError(RuntimeError):
    """A PBF is missing, damaged or of an unsupported kind."""


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message: integers for varints, bytes for the rest."""
    at, end = 0, len(data)
    while at < end:
        tag, at = (data[at], at + 1) if data[at] < 0x80 else _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at) if at == end or data[at] > 0x7F else (data[at], at + 1)
            value, at = data[at : at + size], at + size
            if at > end:
                raise ValueError("field runs past its message")
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unsupported wire type {kind}")
        yield tag >> 3, value


def packed(data: bytes) -> np.ndarray:
    """The varints of a packed field, all at once."""
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 0x80)
    if not len(ends):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(ends[-1] + 1) - np.repeat(starts, ends - starts + 1)
    parts = (raw[: ends[-1] + 1] & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(parts, starts).astype(np.int64)


def _numbers(data: bytes) -> list[int]:
    """:func:`packed` as a list, for few and mostly small numbers."""
    if data.isascii():
        return list(data)
    if len(data) > 64 or data[-1] > 0x7F:
        return packed(data).tolist()
    out, at = [], 0
    while at < len(data):
        value, at = _varint(data, at)
        out.append(value)
    return out


def _zigzag(values: np.ndarray) -> np.ndarray:
    return (values >> 1) ^ -(values & 1)


class _File:
    """A file that is read at any place."""

    def __init__(self, stream: BinaryIO, size: int) -> None:
        self.stream, self.size, self.held, self.low = stream, size, b"", 0

    def hold(self, low: int, high: int) -> bytes:
        """Keep a stretch at hand, for many small reads."""
        self.held, self.low = self.read(low, max(0, min(high, self.size) - low)), low
        return self.held

    def read(self, at: int, size: int) -> bytes:
        if self.low <= at and at + size <= self.low + len(self.held):
            return self.held[at - self.low : at - self.low + size]
        self.stream.seek(at)
        data = self.stream.read(size)
        if len(data) < size:
            raise ValueError("file ends within a blob")
        return data

    def head(self, at: int) -> tuple[bytes, int, int]:
        """Type of the blob at ``at``, where its content starts, and where the next blob does."""
        size = int.from_bytes(self.read(at, 4), "big")
        if size > MAX_HEADER:
            raise ValueError("damaged blob header")
        found = dict(fields(self.read(at + 4, size)))
        length, kind = found.get(3, -1), found.get(1)
        if not isinstance(length, int) or not 0 <= length <= MAX_BLOB or not isinstance(kind, bytes) or not kind:
            raise ValueError("damaged blob header")
        if (stop := at + 4 + size + length) > self.size:
            raise ValueError("file ends within a blob")
        return kind, at + 4 + size, stop


@contextmanager
def _opened(path: str) -> Iterator[_File]:
    if "://" in path:
        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_file(inner) as stream:
            yield _File(stream, stream.size())
    else:
        with open(path, "rb") as stream:
            yield _File(stream, os.fstat(stream.fileno()).st_size)


def _size(path: str) -> int:
    """Bytes of a file, without opening it."""
    if "://" in path:
        store, inner = fs.FileSystem.from_uri(path)
        info = store.get_file_info(inner)
        if info.type != fs.FileType.File:
            raise PBFReadError(f"PBF is not a file: {path}")
        return info.size
    if not os.path.isfile(path):
        raise PBFReadError(f"PBF is not a file: {path}")
    return os.path.getsize(path)


def _walked(file: _File, at: int, start: int) -> int:
    """The first blob at or behind ``start``, header by header from the blob at ``at``."""
    while at < start:
        at = file.head(at)[2]
    return at


def _starts(data: bytes) -> Iterator[int]:
    """Where headers may start, overlapping ones included."""
    at = 0
    while found := _START.search(data, at):
        yield found.start()
        at = found.start() + 1


def first_blob(file: _File, start: int) -> int:
    """Offset of the first blob at or behind ``start``.

    A blob has a bounded size, so at least one starts in the stretch of that size before ``start``. Every place in it where a
    header can be read, and from which headers lead on to ``start``, is a candidate; true ones are all among them. If each candidate leads to
    the next, all behind a true one are true, and so is the first at or behind ``start``. Otherwise the content looks like headers somewhere, and
    headers are walked from the file's beginning, which is slow but right.
    """
    low = start - (4 + MAX_HEADER + MAX_BLOB) + 1
    if low <= 0:
        return _walked(file, 0, start)
    data, leads = file.hold(low, start + 4 + MAX_HEADER), {}
    for found in _starts(data[: start - low + 5]):
        try:
            leads[low + found] = file.head(low + found)[2]
        except (ValueError, IndexError):
            continue
    lands: dict[int, bool] = {}
    for at in sorted(leads, reverse=True):
        to = leads[at]
        if to <= start:
            lands[at] = lands.get(to, False)
        else:
            try:
                lands[at] = to == file.size or bool(file.head(to))
            except (ValueError, IndexError):
                lands[at] = False
        if at == start:
            lands[at] = True
    chain = sorted(at for at, ok in lands.items() if ok)
    if chain and all(leads[one] == other for one, other in zip(chain, chain[1:], strict=False)):
        return chain[-1] if chain[-1] == start else leads[chain[-1]]
    return _walked(file, 0, start)


def _blob(data: bytes) -> bytes:
    found = dict(fields(data))
    if 1 in found:
        return found[1]
    if 3 in found:
        return zlib.decompress(found[3])
    if 7 in found:
        import zstandard

        return zstandard.decompress(found[7], max_output_size=found.get(2, MAX_BLOB))
    raise ValueError("unsupported blob compression")


def check_header(data: bytes) -> None:
    unknown = [v.decode() for n, v in fields(_blob(data)) if n == 4 and v not in FEATURES]
    if unknown:
        raise ValueError(f"unsupported features: {', '.join(unknown)}")


def _groups(block: bytes, kinds: Iterable[str] = tuple(KINDS)) -> tuple[list[bytes], dict[str, list[bytes]]]:
    """Strings of a block and the elements of the wanted kinds; strings only if something needs them."""
    strings, found, wanted = [], {kind: [] for kind in kinds}, {KINDS[kind]: kind for kind in kinds}
    for number, value in fields(block):
        if number == 1:
            strings = value
        elif number == 2:
            for kind, element in fields(value):
                if kind in wanted:
                    found[wanted[kind]].append(element)
    return ([v for n, v in fields(strings) if n == 1] if strings and any(found.values()) else []), found


def _message(data: bytes) -> dict[int, int | bytes]:
    """The fields of a way or relation by number. A packed field may come in several pieces, which belong behind each other."""
    found: dict[int, int | bytes] = {}
    for number, value in fields(data):
        before = found.get(number)
        found[number] = before + value if isinstance(value, bytes) and isinstance(before, bytes) else value
    return found


def _references(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Node references of many ways, concatenated, and where each begins."""
    data = b"".join(lists)
    deltas = _zigzag(packed(data))
    ended = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) < 0x80)])
    sizes = np.diff(ended[np.cumsum([0, *map(len, lists)])])
    starts = np.cumsum(sizes) - sizes
    total = np.cumsum(deltas)
    before = np.where(starts > 0, total[starts - 1], 0) if len(total) else np.zeros(len(lists), np.int64)
    return total - np.repeat(before, sizes), np.append(starts, len(total))


def closed(refs: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Which ways close a ring."""
    n, out = np.diff(starts), np.zeros(len(starts) - 1, bool)
    at = np.flatnonzero(n >= (3 if rule == "first3" else 4))
    first, last = refs[starts[at]], refs[starts[at + 1] - 1]
    ok = first == last
    if rule == "first3":
        second, third = refs[starts[at] + 1], refs[starts[at] + 2]
        ok &= (first != second) & (first != third) & (second != third)
    else:
        ok &= np.array([len(np.unique(refs[starts[i] : starts[i + 1] - 1])) >= 3 for i in at], bool)
    out[at] = ok
    return out


def _tags(found: dict, strings: list[bytes]) -> list[tuple[str, str]]:
    keys, values = (packed(found.get(n, b"")).tolist() for n in (2, 3))
    text = lambda i: strings[i].decode("utf-8", "replace")
    return [(text(k), text(v)) for k, v in zip(keys, values, strict=False)]


def block_identities(block: bytes, rule: str, kinds: Iterable[str] = tuple(KINDS)) -> tuple[list[int], list[int]]:
    """Ids of closed ways and of area relations in a decompressed block; ids that aren't positive are passed over, kinds that aren't wanted undecoded."""
    strings, found = _groups(block, kinds)
    parsed = [_message(w) for w in found.get("way", ())]
    way_ids: list[int] = []
    if parsed:
        refs, starts = _references([w.get(8, b"") for w in parsed])
        ids = np.array([w.get(1, 0) for w in parsed], np.uint64).astype(np.int64)
        way_ids = ids[closed(refs, starts, rule) & (ids > 0)].tolist()
    areas = {i for i, s in enumerate(strings) if s in _AREAS}
    named = {i for i, s in enumerate(strings) if s == b"type"}
    relation_ids = []
    for relation in map(_message, found.get("relation", ())):
        pairs = zip(*(_numbers(relation.get(n, b"")) for n in (2, 3)), strict=False)
        if any(k in named and v in areas for k, v in pairs) and 0 < relation.get(1, 0) < 1 << 63:
            relation_ids.append(relation[1])
    return way_ids, relation_ids


def block_elements(block: bytes, kinds: Iterable[str] = tuple(KINDS), refs_too: bool = True, tags_too: bool = True) -> Iterator[tuple[str, int, list[int], list[tuple[str, str]]]]:
    """All ways and relations of a block: type, id, references (none for relations), tags; what isn't wanted is empty."""
    strings, found = _groups(block, kinds)
    tags = _tags if tags_too else lambda found, strings: []
    parsed = [_message(w) for w in found.get("way", ())]
    if parsed:
        refs, starts = _references([w.get(8, b"") if refs_too else b"" for w in parsed])
        for i, w in enumerate(parsed):
            yield "way", w.get(1, 0), refs[starts[i] : starts[i + 1]].tolist(), tags(w, strings)
    for relation in map(_message, found.get("relation", ())):
        yield "relation", relation.get(1, 0), [], tags(relation, strings)


class Stretch(InputPartition):
    """The blobs of one file that start in a range of bytes."""

    def __init__(self, path: str, source: str, start: int, stop: int) -> None:
        self.path, self.source, self.start, self.stop = path, source, start, stop


class PbfReader(DataSourceReader):
    def __init__(self, options: dict, columns: Iterable[str] = ()) -> None:
        self.columns = list(columns) or None
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.mode, self.rule = options.get("mode") or ("elements" if {"refs", "tags"} & {*columns} else "identities"), options.get("ring_rule", "first3")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        if self.rule not in RING_RULES or self.mode not in ("identities", "elements") or self.split < 1:
            raise ValueError(f"bad options: mode={self.mode}, ring_rule={self.rule}, split_bytes={self.split}")
        whole = IDENTITIES if self.mode == "identities" else ELEMENTS
        if unknown := {*columns} - {*whole.names}:
            raise ValueError(f"no such columns in mode {self.mode}: {sorted(unknown)}")
        self.schema = T.StructType([whole[c] for c in self.columns or whole.names])
        #: Values that filters leave of a column; None: all.
        self.wanted: dict[str, set | None] = {"osm_type": None, "source": None}
        #: Elements decoded so far, by kind.
        self.decoded: Counter = Counter()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and membership on type and source; no key is ever null."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 else None
            if isinstance(f, IsNotNull) and name in IDENTITIES.names:
                continue
            if isinstance(f, (EqualTo, In)) and name in self.wanted:
                values = {*f.value} if isinstance(f, In) else {f.value}
                before = self.wanted[name]
                self.wanted[name] = values if before is None else before & values
                continue
            yield f

    def _keeps(self, column: str, value: str) -> bool:
        return self.wanted[column] is None or value in self.wanted[column]

    def partitions(self) -> list[Stretch]:
        named = [(path, path.rsplit("/", 1)[-1].removesuffix(".osm.pbf")) for path in map(str, self.paths)]
        files = [(path, source, _size(path)) for path, source in named if self._keeps("source", source)]
        split = max(self.split, min(SPLIT_BYTES, -(-sum(size for *_, size in files) // MANY)))
        out = [Stretch(path, source, at, min(at + split, size)) for path, source, size in files for at in range(0, size, split)]
        return out or [Stretch("", "", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        kinds = [k for k in KINDS if self._keeps("osm_type", k)]
        if not partition.path:
            return
        try:
            with _opened(partition.path) as file:
                rows: dict[str, list] = {c: [] for c in self.schema.names}
                rows["osm_id"] = []
                at = first_blob(file, partition.start)
                while at < partition.stop:
                    kind, content, stop = file.head(at)
                    if kind == b"OSMHeader":
                        check_header(file.read(content, stop - content))
                    elif kind == b"OSMData" and kinds:
                        self._decode(_blob(file.read(content, stop - content)), partition.source, kinds, rows)
                    if len(rows["osm_id"]) >= BATCH_ROWS:
                        yield self._batch(rows)
                    at = stop
                if rows["osm_id"]:
                    yield self._batch(rows)
        except (OSError, ValueError, IndexError, zlib.error) as why:
            raise PBFReadError(f"cannot read PBF {partition.path}: {why}") from why

    def _batch(self, rows: dict[str, list]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)
        for column in rows.values():
            column.clear()
        return batch

    def _decode(self, block: bytes, source: str, kinds: list[str], rows: dict[str, list]) -> None:
        if self.mode == "identities":
            ids = dict(zip(KINDS, block_identities(block, self.rule, kinds), strict=True))
            found = {"source": [source] * sum(map(len, ids.values())), "osm_type": [k for k, x in ids.items() for _ in x], "osm_id": [i for x in ids.values() for i in x]}
        else:
            elements = list(block_elements(block, kinds, "refs" in rows, "tags" in rows))
            found = {"source": [source] * len(elements), "osm_type": [e[0] for e in elements], "osm_id": [e[1] for e in elements], "refs": [e[2] for e in elements], "tags": [[{"k": k, "v": v} for k, v in e[3]] for e in elements]}
        self.decoded.update(found["osm_type"])
        for name, column in rows.items():
            column += found[name]


class PbfDataSource(DataSource):
    """Keys or elements of OpenStreetMap PBF files."""

    @classmethod
    def name(cls) -> str:
        return "osmpbf"

    def schema(self) -> T.StructType:
        return ELEMENTS if self.options.get("mode") == "elements" else IDENTITIES

    def reader(self, schema: T.StructType) -> PbfReader:
        return PbfReader(dict(self.options), schema.names)


def register(spark: SparkSession) -> None:
    """Make the source known to a session and let filters reach it, which Spark leaves off."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PbfDataSource)


class KeyReader:
    """Reads one file without Spark and calls ``callback`` with each key. Any object that is made and used like it can take its place."""

    def __init__(self, *, callback: Callable[[Identity], None], ring_rule: str = "first3") -> None:
        self.callback, self.ring_rule = callback, ring_rule

    def apply_file(self, filename: str, *, locations: bool = False) -> None:
        """``locations`` asks for coordinates, which this reader has none of."""
        if locations:
            raise ValueError("no locations of nodes are read")
        reader = PbfReader({"path": filename, "ring_rule": self.ring_rule, "split_bytes": str(1 << 62)})
        for part in reader.partitions():
            for batch in reader.read(part):
                for kind, ident in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    self.callback(Identity(kind, ident))


def scan_pbf_keys(path: Path | str, callback: Callable[[Identity], None], *, ring_rule: str = "first3", handler_factory: Callable | None = None) -> None:
    """Without Spark: call ``callback`` with an Identity for each key of one file.

    ``handler_factory(callback=...)`` makes another reader; what goes wrong in it is a :class:`PBFReadError` like any other damage.
    """
    if not Path(path).exists():
        raise PBFReadError(f"PBF does not exist: {path}")
    if not Path(path).is_file():
        raise PBFReadError(f"PBF is not a file: {path}")
    try:
        handler = handler_factory(callback=callback) if handler_factory else KeyReader(callback=callback, ring_rule=ring_rule)
        handler.apply_file(str(path), locations=False)
    except PBFReadError:
        raise
    except (OSError, RuntimeError, ValueError) as why:
        raise PBFReadError(f"cannot read PBF {path}: {why}") from why
