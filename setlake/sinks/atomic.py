"""Atomic outputs on a file system that driver and executors share: write beside, then rename."""

from __future__ import annotations

import json
import os
import re
import shutil
from collections.abc import Sequence
from contextlib import ExitStack, suppress
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from setlake.schemas import arrow, conform


def put(path: Path, content: bytes) -> None:
    """All of ``content`` under ``path``, or what was there before: it is complete under a hidden name beside it before it takes the place."""
    beside = path.with_name(f".{path.name}.tmp")
    beside.parent.mkdir(parents=True, exist_ok=True)
    with ExitStack() as left:
        left.callback(beside.unlink, missing_ok=True)
        beside.write_bytes(content)
        os.replace(beside, path)


def write_json(path: Path, payload: dict) -> None:
    """Sorted keys, two spaces, a line feed at the end."""
    put(path, f"{json.dumps(payload, indent=2, sort_keys=True, ensure_ascii=False)}\n".encode())


def stored_object(path: Path) -> dict | None:
    """The JSON object that a file holds. None stands for every other case: no file, no UTF-8, no JSON, or JSON of another kind."""
    found = None
    if path.is_file():
        with suppress(ValueError, OSError):
            found = json.loads(path.read_bytes().decode())
    return found if isinstance(found, dict) else None


def matches_schema(path: Path, schema: T.StructType) -> bool:
    """Whether a file is Parquet of exactly this schema."""
    try:
        return pq.read_schema(path).remove_metadata().equals(arrow(schema))
    except (OSError, ValueError, pa.ArrowException):
        return False


def write_empty(path: Path, schema: T.StructType) -> None:
    buffer = pa.BufferOutputStream()
    pq.write_table(arrow(schema).empty_table(), buffer, compression="zstd")
    put(path, buffer.getvalue().to_pybytes())


def promote_parts(df: DataFrame, outputs: Sequence[Path], schema: T.StructType, rows_per_group: int | None = None) -> None:
    """Write partition *i* of ``df`` as the file ``outputs[i]``, zstd, of exactly ``schema``.

    Spark's committer writes the parts to a hidden sibling folder; each is then renamed. Partitions without
    rows have no part, so their files are made here.
    """
    staging = outputs[0].parent / f".{outputs[0].name}.parts"
    staging.parent.mkdir(parents=True, exist_ok=True)
    shutil.rmtree(staging, ignore_errors=True)
    try:
        writer = conform(df, schema).write.option("compression", "zstd")
        if rows_per_group:
            writer = writer.option("parquet.block.row.count.limit", rows_per_group)
        writer.parquet(staging.resolve().as_uri())
        parts = {int(m[1]): p for p in staging.glob("part-*.parquet") if (m := re.match(r"part-(\d+)", p.name))}
        for i, output in enumerate(outputs):
            if i in parts:
                parts[i].replace(output)
            else:
                write_empty(output, schema)
            output.with_name(f".{output.name}.crc").unlink(missing_ok=True)
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def write_single(df: DataFrame, output: Path, schema: T.StructType, rows_per_group: int | None = None) -> None:
    """One file. What comes before keeps its parallelism; only the last, narrow rows meet in one task."""
    promote_parts(df.repartition(1), [output], schema, rows_per_group)


def footer_rows(path: Path) -> int:
    return pq.read_metadata(path).num_rows
