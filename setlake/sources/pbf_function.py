"""The PBF scanner as a table function of SQL.

``register_function(spark)``, then ``SELECT * FROM pbf_scan(TABLE(stretches), 'identities', 'first3')``, where ``stretches`` is a table of path, start and stop, such as
:func:`stretches` makes: each of its partitions is a task, and any cuts give the same rows. The mode decides the columns, as for the data
source; mode and ring rule may be left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from setlake.sources.pbf import SPLIT_BYTES, PbfReader, Stretch


def _reader(mode: str | None, ring_rule: str | None) -> PbfReader:
    return PbfReader({"path": "", "mode": mode or "identities", "ring_rule": ring_rule or "first3"})


@udtf
class PbfScan:
    """Rows of stretches of PBF files."""

    @staticmethod
    def analyze(stretch: AnalyzeArgument, mode: AnalyzeArgument | None = None, ring_rule: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not stretch.isTable:
            raise ValueError("pbf_scan takes a table of path, start and stop")
        for name, given in (("mode", mode), ("ring_rule", ring_rule)):
            if given is not None and not given.isConstantExpression:
                raise ValueError(f"{name} is to be a constant")
        return AnalyzeResult(_reader(mode and mode.value, ring_rule and ring_rule.value).schema)

    def eval(self, stretch: Row, mode: str | None = None, ring_rule: str | None = None) -> Iterator[tuple]:
        path = stretch["path"]
        part = Stretch(path, path.rsplit("/", 1)[-1].removesuffix(".osm.pbf"), stretch["start"], stretch["stop"])
        for batch in _reader(mode, ring_rule).read(part):
            columns = [c.to_pylist() for c in batch.columns]
            if len(columns) == 5:
                columns[4] = [[(t["k"], t["v"]) for t in tags] for tags in columns[4]]
            yield from zip(*columns, strict=True)


def stretches(spark: SparkSession, paths: Sequence[Path | str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Files cut by size into rows path, start, stop, each a partition."""
    parts = [(p.path, p.start, p.stop) for p in PbfReader({"paths": json.dumps([str(p) for p in paths]), "split_bytes": str(split_bytes)}).partitions() if p.path]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(parts)], "i int, path string, start long, stop long")
    return rows.repartitionById(max(1, len(parts)), F.col("i")).drop("i")


def register_function(spark: SparkSession) -> None:
    spark.udtf.register("pbf_scan", PbfScan)
