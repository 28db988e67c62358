"""Stage 1: raw identities of every PBF, one file each, with checkpoints that a later run resumes from.

Files are taken in groups: at least ``workers`` of them, and more as long as they are small, so that many small files are one job. Within a
group all executors share the blobs of every file. Each group's files get their checkpoints before the next group starts, so what fails later
costs only itself. A group with a damaged file is taken again in halves, and the damage is raised once all good files are saved. The
driver reads names, sizes and checkpoints; digests, row counts and schemas of files are looked up by tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from queue import Queue
from threading import Thread

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlake.functions.predicates import Identity
from setlake.paths import DataPaths
from setlake.schemas import IDENTITY
from setlake.sinks.atomic import footer_rows, matches_schema, promote_parts, stored_object, write_json
from setlake.sources.files import pbf_files, sha256, unreadable
from setlake.sources.pbf import SPLIT_BYTES, PBFReadError, register

MAX_WORKERS, BATCH_ROWS = 8, 100_000
#: Bytes and files of a group, beyond its ``workers`` files.
GROUP_BYTES, GROUP_FILES = 8 << 30, 512
Scanner = Callable[[Path, Callable[[Identity], None]], None]


class ExtractionError(RuntimeError):
    """Extraction inputs or options break the contract."""


class InputChangedError(ExtractionError):
    """A source changed while it was read."""


@dataclass(frozen=True, slots=True)
class Snapshot:
    """What a source file was at one moment; an empty digest means only its size and time were looked at."""

    path: Path
    size_bytes: int
    mtime_ns: int
    sha256: str = ""

    @classmethod
    def stat_only(cls, path: Path) -> Snapshot:
        stat = path.stat()
        return cls(path, stat.st_size, stat.st_mtime_ns)

    @classmethod
    def read(cls, path: Path) -> Snapshot:
        seen = cls.stat_only(path)
        return cls(path, seen.size_bytes, seen.mtime_ns, sha256(path))

    def unchanged(self, later: Snapshot) -> bool:
        return (self.size_bytes, self.mtime_ns) == (later.size_bytes, later.mtime_ns) and later.sha256 in ("", self.sha256)


@dataclass(frozen=True, slots=True)
class Content:
    """What an output file holds."""

    sha256: str
    rows: int
    sound: bool

    @classmethod
    def read(cls, path: Path) -> Content:
        """Of a file that is no Parquet of identities, or gone, nothing is sound."""
        try:
            return cls(sha256(path), footer_rows(path), matches_schema(path, IDENTITY))
        except (OSError, ValueError, pa.ArrowException):
            return cls("", -1, False)


@dataclass(frozen=True, slots=True)
class Source:
    """A PBF with the files that belong to it in a run."""

    path: Path
    run_root: Path

    @property
    def stem(self) -> str:
        return self.path.name.removesuffix(".osm.pbf")

    @property
    def output(self) -> Path:
        return self.run_root / "raw-identities" / f"{self.stem}.parquet"

    @property
    def checkpoint(self) -> Path:
        return self.run_root / "checkpoints" / f"{self.stem}.json"

    def clear(self) -> None:
        """Delete whatever an interrupted run left."""
        for path in (self.output, self.checkpoint):
            path.unlink(missing_ok=True)
            path.with_name(f".{path.name}.tmp").unlink(missing_ok=True)

    def save(self, snapshot: Snapshot, mode: str, content: Content) -> int:
        stat = self.output.stat()
        described = {"path": self.output.relative_to(self.run_root).as_posix(), "size_bytes": stat.st_size, "mtime_ns": stat.st_mtime_ns, "row_count": content.rows, "sha256": content.sha256}
        write_json(self.checkpoint, {"source_pbf": self.path.name, "size_bytes": snapshot.size_bytes, "mtime_ns": snapshot.mtime_ns, "sha256": snapshot.sha256, "row_count": content.rows, "scanner_mode": mode, "output": described})
        return content.rows

    def restore(self, mode: str, content: Content | None = None) -> tuple[int, Snapshot] | None:
        """Rows and snapshot of a completed extraction, if its checkpoint, source and output (``content``; read here if not given) all still agree."""
        saved = stored_object(self.checkpoint) or {}
        output, rows, digest = saved.get("output"), saved.get("row_count"), saved.get("sha256")
        if not isinstance(output, dict) or isinstance(rows, bool) or not isinstance(rows, int) or rows < 0 or not isinstance(digest, str) or not digest:
            return None
        try:
            now, stat = Snapshot.stat_only(self.path), self.output.stat()
        except OSError:
            return None
        content = content or Content.read(self.output)
        claimed = {"source_pbf": self.path.name, "scanner_mode": mode, "size_bytes": now.size_bytes, "mtime_ns": now.mtime_ns, "row_count": content.rows}
        described = {"path": self.output.relative_to(self.run_root).as_posix(), "size_bytes": stat.st_size, "mtime_ns": stat.st_mtime_ns, "row_count": rows, "sha256": content.sha256}
        if not content.sound or any(saved.get(k) != v for k, v in claimed.items()) or any(output.get(k) != v for k, v in described.items()):
            return None
        return rows, Snapshot(self.path, now.size_bytes, now.mtime_ns, digest)


@dataclass(frozen=True, slots=True)
class ExtractionResult:
    run_root: Path
    occurrence_count: int
    sources: tuple[Snapshot, ...]
    outputs: tuple[Path, ...]


def scanner_mode(scanner: Scanner | None, ring_rule: str = "first3") -> str:
    """What a checkpoint's identities were made by: another scanner or another ring rule makes others."""
    return "custom" if scanner is not None else "coverage-only" if ring_rule == "first3" else f"coverage-only:{ring_rule}"


def scan(spark: SparkSession, paths: Sequence[Path | str], ring_rule: str = "first3", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Raw occurrences (source, osm_type, osm_id) of PBF files."""
    register(spark)
    return spark.read.format("osmpbf").option("paths", json.dumps([str(p) for p in paths])).option("ring_rule", ring_rule).option("split_bytes", split_bytes).load()


def _told(scanner: Scanner, path: Path, rows: int) -> Iterator[list[Identity]]:
    """What ``scanner`` tells of a file, ``rows`` at a time; it waits while two lots are not yet taken."""
    lots: Queue = Queue(2)

    def work() -> None:
        held: list[Identity] = []

        def take(found: Identity) -> None:
            held.append(found)
            if len(held) >= rows:
                lots.put(held[:])
                held.clear()

        try:
            scanner(path, take)
            lots.put(held)
            lots.put(None)
        except BaseException as why:  # noqa: BLE001 - raised again where the lots are taken
            lots.put(why)

    Thread(target=work, daemon=True).start()
    while (lot := lots.get()) is not None:
        if isinstance(lot, BaseException):
            raise lot
        yield lot


def _scan_custom(spark: SparkSession, paths: list[Path], scanner: Scanner) -> DataFrame:
    """The same by a function of the caller, one file a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                source = Path(name).name.removesuffix(".osm.pbf")
                for part in _told(scanner, Path(name), BATCH_ROWS):
                    yield pa.RecordBatch.from_pydict({"source": [source] * len(part), "osm_type": [i.osm_type for i in part], "osm_id": [i.osm_id for i in part]})

    files = spark.createDataFrame([(str(p),) for p in paths], "path string").repartition(len(paths))
    return files.mapInArrow(run, "source string, osm_type string, osm_id long")


def _in_tasks(spark: SparkSession, paths: Sequence[Path], look: Callable[[Path], tuple], schema: str) -> list[tuple]:
    """``look`` at each file in a task of its own; one short row a file comes back."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [look(Path(p)) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"i": batch.column(0).to_pylist()} | {n: [s[k] for s in seen] for k, n in enumerate(names)})

    if not paths:
        return []
    files = spark.createDataFrame([(i, str(p)) for i, p in enumerate(paths)], "i int, path string").repartitionById(len(paths), F.col("i"))
    return [tuple(r)[1:] for r in sorted(files.mapInArrow(run, f"i long, {schema}").collect())]


def _snapshots(spark: SparkSession, sources: list[Source]) -> dict[Source, Snapshot]:
    """Snapshots with digests."""
    def look(path: Path) -> tuple:
        seen = Snapshot.read(path)
        return seen.size_bytes, seen.mtime_ns, seen.sha256

    found = _in_tasks(spark, [s.path for s in sources], look, "size long, mtime long, sha256 string")
    return {s: Snapshot(s.path, *row) for s, row in zip(sources, found, strict=True)}


def _contents(spark: SparkSession, sources: list[Source]) -> dict[Source, Content]:
    """What the outputs hold."""
    def look(path: Path) -> tuple:
        seen = Content.read(path)
        return seen.sha256, seen.rows, seen.sound

    found = _in_tasks(spark, [s.output for s in sources], look, "sha256 string, rows long, sound boolean")
    return {s: Content(*row) for s, row in zip(sources, found, strict=True)}


def _groups(sources: list[Source], workers: int, alone: bool) -> list[list[Source]]:
    """Sources in groups: ``workers`` files at least, more while they are small; ``alone``: one by one."""
    out: list[list[Source]] = []
    size = 0
    for source in sources:
        more = source.path.stat().st_size
        full = not out or alone or len(out[-1]) >= GROUP_FILES or len(out[-1]) >= workers and size + more > GROUP_BYTES
        if full:
            out.append([])
            size = 0
        out[-1].append(source)
        size += more
    return out


def extract_all(spark: SparkSession, paths: DataPaths, run_id: str, *, scanner: Scanner | None = None, batch_rows: int = BATCH_ROWS, workers: int = 1, resume: bool = False, ring_rule: str = "first3") -> ExtractionResult:
    """Extract every PBF of the raw root, at least ``workers`` files at a time, each read by as many tasks as the cluster has room for.

    Checkpoints are always written; only ``resume`` reads them.
    """
    if not 1 <= workers <= MAX_WORKERS:
        raise ValueError(f"{workers} workers; from 1 to {MAX_WORKERS} are allowed")
    if batch_rows < 1:
        raise ValueError(f"{batch_rows} rows a batch; at least one is needed")
    if workers > 1 and scanner is not None:
        raise ExtractionError("several files at once need the default scanner")
    if not paths.raw_pbf_root.is_dir():
        raise ExtractionError(f"no folder of PBF files: {paths.raw_pbf_root}")
    files = pbf_files(paths.raw_pbf_root)
    if not files:
        raise ExtractionError(f"no regular PBF file in {paths.raw_pbf_root}")
    if names := unreadable(files):
        raise ExtractionError(f"no right to read {', '.join(names)}")
    root, mode = paths.run_root(run_id), scanner_mode(scanner, ring_rule)
    if root.exists() and not resume:
        raise ExtractionError(f"the run already exists: {root}")
    sources = [Source(p, root) for p in files]
    (root / "raw-identities").mkdir(parents=True, exist_ok=True)
    (root / "checkpoints").mkdir(parents=True, exist_ok=True)
    there = [s for s in sources if s.checkpoint.is_file() and s.output.is_file()] if resume else []
    done = {s: saved for s, content in _contents(spark, there).items() if (saved := s.restore(mode, content))}
    pending = [s for s in sources if s not in done]
    for source in pending:
        source.clear()
    groups, failed = _groups(pending, workers, scanner is not None), []
    for group in groups:
        try:
            done |= _extract(spark, group, scanner, mode, batch_rows, ring_rule)
        except PBFReadError as why:
            if len(group) > 1:
                groups += [group[: len(group) // 2], group[len(group) // 2 :]]
            else:
                failed.append(why)
    if failed:
        for why in failed[1:]:
            failed[0].add_note(str(why))
        raise failed[0]
    return ExtractionResult(root, sum(done[s][0] for s in sources), tuple(done[s][1] for s in sources), tuple(s.output for s in sources))


def _extract(spark: SparkSession, group: list[Source], scanner: Scanner | None, mode: str, batch_rows: int, ring_rule: str) -> dict[Source, tuple[int, Snapshot]]:
    """Write the files of a group and their checkpoints; rows and snapshots of each."""
    before = _snapshots(spark, group)
    files = [s.path for s in group]
    rows = scan(spark, files, ring_rule) if scanner is None else _scan_custom(spark, files, scanner)
    number = spark.createDataFrame([(s.stem, i) for i, s in enumerate(group)], "source string, number int")
    dealt = rows.join(F.broadcast(number), "source").repartitionById(len(group), F.col("number"))  # at most GROUP_FILES rows are broadcast
    try:
        promote_parts(dealt, [s.output for s in group], IDENTITY, batch_rows)
    except PySparkException as why:
        # Spark tells of an error in a task, or in a source's planning, by its text alone
        if told := re.search(rf"\b{PBFReadError.__name__}: ([^\n]*)", str(why)):
            raise PBFReadError(told[1]) from why
        raise
    contents = _contents(spark, group)
    for source in group:
        if not before[source].unchanged(Snapshot.stat_only(source.path)):
            raise InputChangedError(f"source PBF changed during scan: {source.path}")
    return {source: (source.save(before[source], mode, contents[source]), before[source]) for source in group}
