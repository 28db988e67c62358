"""Helpers shared by the training-data operators: shared scratch tables, row keys, Arrow maps.

Intermediate tables go to the shared folder that the session names in ``spark.checkpoint.dir``; they
cut lineage and outlive lost executors. Only where that setting is absent and driver and executors are one process (tests, a laptop)
does ``shared_dir`` choose a folder of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlake.session import scratch, shared_dir

__all__ = ["scratch", "shared_dir"]

_worker_caches: list = []
_last_work: list[object] = []


def worker_cache(make: Callable) -> Callable:
    """``functools.cache`` for what a Python worker keeps from task to task; emptied when the worker turns to other work."""
    cached = cache(make)
    _worker_caches.append(cached)
    return cached


def begin_work(name: object) -> None:
    """Called at the start of a task: if the worker did something else before, what it kept for that goes; what tasks before freed goes back to the system."""
    if _last_work != [name]:
        _last_work[:] = [name]
        for cached in _worker_caches:
            cached.cache_clear()
    give_back()


def give_back() -> None:
    """Return freed memory to the system: allocators keep it otherwise, and workers outlive their tasks beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def nullable(schema: T.StructType) -> T.StructType:
    """``schema`` with every top-level column nullable, as Parquet reads it back."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in the lineage that any executor can read again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return at_path(spark.read.schema(nullable(df.schema)).parquet(path), path)


def at_path(df: DataFrame, path: str) -> DataFrame:
    """``df``, which :func:`drop_scratch` may delete the files of."""
    df._scratch_path = path
    return df


def drop_scratch(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files behind tables that :func:`materialise` made, once nothing reads them; other tables are left alone."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        if named := vars(df).get("_scratch_path"):
            path = spark._jvm.org.apache.hadoop.fs.Path(named)
            path.getFileSystem(conf).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of plans that are over; it works when the driver collects garbage."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def numbered_columns(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns c0, c1 and so on, and what ``names`` are called there, so that no name of the caller's meets an internal one.

    ``toDF(*df.columns)`` gives the names back.
    """
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [f"c{df.columns.index(n)}" for n in names]


def with_key(df: DataFrame, id_col: str, text_col: str, name: str = "keyed") -> tuple[DataFrame, bool]:
    """``df`` with a unique non-null long ``_key`` that sorts as ``id_col`` does, and whether ``_key`` is ``id_col`` itself.

    Unique non-null ids are used as they are (an aggregate over the ids alone decides it). Otherwise
    rows are sorted by (id, nulls first, then a hash of the text, then the text) into a shared table whose row numbers become the
    keys, so that rows sharing an id count as documents of their own, in an order that their texts alone decide.
    """
    ids = df.select(F.col(id_col).cast("long").alias("i"))
    odd = ids.groupBy("i").count().filter((F.col("count") > 1) | F.col("i").isNull()).limit(1).count()
    if not odd:
        return df.withColumn("_key", F.col(id_col).cast("long")), True
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order, F.col(text_col).asc_nulls_first())
    return materialise(ranged.withColumn("_key", F.monotonically_increasing_id()), name), False


def running_sums(df: DataFrame, by: list[str], order: list[Column], values: list[str], name: str = "running") -> DataFrame:
    """``df`` with ``before_<v>`` for each of ``values``: the sum of that column over the rows before, in ``order``, within a group.

    Rows are sorted by range into a shared table, so no task holds a group: sums within a stretch come from a window over it, and the stretches' own
    sums (one row per group and stretch) give what came before. Rows that tie in ``order`` follow each other in any way.
    """
    keys = [F.col(c).asc_nulls_last() for c in by] + order
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    rows = materialise(ranged, name).withColumn("_part", F.shiftright("_row", 33))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*by, "_part").agg(*[F.sum(v).alias(v) for v in values])
    starts = sums.select(*by, "_part", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_start_{v}") for v in values])
    within = Window.partitionBy(*by, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_within_{v}") for v in values])
    added = [(F.col(f"_start_{v}") + F.col(f"_within_{v}")).alias(f"before_{v}") for v in values]
    return rows.join(starts, [*by, "_part"]).select(*df.columns, *added)


def arrow_rows(df: DataFrame, fn: Callable[..., dict], schema: str, rows: int = 256) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows.

    ``fn`` gets the columns of ``df`` as Python lists and returns a dict of equally long output columns.
    Slices bound what a task holds.
    """
    struct = T.StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, name = to_arrow_schema(struct), f"{fn.__module__}.{fn.__qualname__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_work(name)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = fn(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
        give_back()

    return df.mapInArrow(run, struct)
