"""Discovery and validation of source files, by name and footer only; no rows are read here."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Files whose footers one process reads.
LOCAL_FILES = 64


class SourceDatasetError(ValueError):
    """A source tree breaks its contract."""


def regular_file_under(path: Path, root: Path) -> bool:
    """Whether ``path`` is a file that lies under the resolved ``root`` after its own links are followed."""
    return path.is_file() and path.resolve().is_relative_to(root)


def parquet_files(directory: Path, what: str) -> list[Path]:
    """The sorted Parquet files of a folder, all physically inside it.

    Names that Spark's readers pass over (leading dot or underscore) are an error rather than rows lost in silence.
    """
    if not directory.is_dir():
        raise SourceDatasetError(f"{what} directory is missing: {directory}")
    files = sorted(directory.glob("*.parquet"))
    if not files:
        raise SourceDatasetError(f"{what} directory has no Parquet files: {directory}")
    root = directory.resolve()
    for path in files:
        if not regular_file_under(path, root):
            raise SourceDatasetError(f"{what} file is not a regular file under its directory: {path}")
        if path.name.startswith((".", "_")):
            raise SourceDatasetError(f"{what} file has a hidden name: {path}")
    return files


def column_types(path: Path, columns: Sequence[str]) -> list[str | None] | None:
    """The footer's types of ``columns``, None for one that is absent; None in all for a file that is no Parquet."""
    try:
        schema = pq.read_schema(path)
    except (OSError, pa.ArrowException):
        return None
    return [str(schema.field(c).type) if c in schema.names else None for c in columns]


def by_types(files: Sequence[Path], columns: Sequence[str], spark: SparkSession | None = None) -> dict[tuple[str | None, ...], list[Path]]:
    """Files by the types of their ``columns``, in the order of their first file.

    Footers of more than ``LOCAL_FILES`` files are read by tasks, if there is a session: the driver gets a row for each
    distinct schema, with the numbers of its files.
    """
    def told(path: Path) -> str:
        return json.dumps(column_types(path, columns))

    groups: dict[str, list[int]] = {}
    if spark is None or len(files) <= LOCAL_FILES:
        for i, path in enumerate(files):
            groups.setdefault(told(path), []).append(i)
    else:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([told(Path(p)) for p in batch.column(1).to_pylist()], pa.string())], names=["i", "types"])

        listed = spark.createDataFrame(pa.table({"i": list(range(len(files))), "path": [str(p) for p in files]}))
        seen = listed.repartition(-(-len(files) // LOCAL_FILES)).mapInArrow(run, "i long, types string")
        for r in seen.groupBy("types").agg(F.array_sort(F.collect_list("i")).alias("members")).collect():
            groups[r["types"]] = r["members"]
    out = {}
    for types, members in sorted(groups.items(), key=lambda g: g[1][0]):
        if (known := json.loads(types)) is None:
            raise SourceDatasetError(f"Parquet file cannot be read: {files[members[0]]}")
        out[tuple(known)] = [files[i] for i in members]
    return out


def validate_columns(files: Sequence[Path], required: Sequence[str], what: str, spark: SparkSession | None = None) -> None:
    """Every file has the required columns; more are fine, types are left to casts."""
    for types, members in by_types(files, required, spark).items():
        if missing := sorted(c for c, t in zip(required, types, strict=True) if t is None):
            raise SourceDatasetError(f"{what} file lacks columns {', '.join(missing)}: {members[0]}")


def file_inventory(root: Path, files: Iterable[Path], label: str | None = None) -> list[dict]:
    """Relative path, size and modification time of each file, after the label if there is one."""
    out = []
    for path in files:
        stat = path.stat()
        out.append(({"label": label} if label is not None else {}) | {"path": path.relative_to(root).as_posix(), "size_bytes": stat.st_size, "mtime_ns": stat.st_mtime_ns})
    return out


def sha256(path: Path) -> str:
    """Digest of a file's content, read in bounded pieces."""
    with path.open("rb") as stream:
        return hashlib.file_digest(stream, "sha256").hexdigest()


def pbf_files(root: Path) -> list[Path]:
    """The sorted ``*.osm.pbf`` of a folder, not of its children; what leads outside by a link is passed over."""
    base = root.resolve()
    return sorted(p for p in root.glob("*.osm.pbf") if regular_file_under(p, base))


def unreadable(files: Iterable[Path]) -> list[str]:
    return [p.name for p in files if not os.access(p, os.R_OK)]


def _bigint(df: DataFrame, name: str) -> DataFrame:
    """A column as bigint under ANSI rules. Fractions are rounded, not cut: halves of decimals and of numbers in text away from zero, those of floats to even."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.rint(value.cast("double"))
    elif isinstance(kind, T.DecimalType):
        value = F.round(value, 0)
    elif isinstance(kind, T.StringType):
        value = F.round(value.cast("decimal(38,9)"), 0)
    return df.withColumn(name, value.cast("bigint"))


def read_union(spark: SparkSession, files: Sequence[Path], columns: Sequence[str], bigints: Sequence[str] = ("osm_id",)) -> DataFrame:
    """Files of drifting schemas as one table of ``columns``: united by name, absent columns null, ids bigint, the rest strings.

    Files are read in groups of equal footer types, so that each group keeps push-down and pruning.
    """
    out = None
    for members in by_types(files, columns, spark).values():
        part = spark.read.parquet(*map(str, members))
        for name in columns:
            if name not in part.columns:
                part = part.withColumn(name, F.lit(None).cast("bigint" if name in bigints else "string"))
        for name in columns:
            part = _bigint(part, name) if name in bigints else part.withColumn(name, F.col(name).cast("string"))
        part = part.select(*columns)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise SourceDatasetError("no files to read")
    return out
