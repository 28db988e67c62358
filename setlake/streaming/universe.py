"""The universe as a stream of raw identity files: each run of the query takes in the files that came since the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from setlake.schemas import IDENTITY


def identity_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Raw occurrences of a growing folder of identity files."""
    return spark.readStream.schema(IDENTITY).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def new_identities(occurrences: DataFrame) -> DataFrame:
    """Each identity once, when it is first seen. Valid keys only; the state is the set of keys so far."""
    return occurrences.filter(F.col("osm_type").isNotNull() & F.col("osm_id").isNotNull()).dropDuplicates(["osm_type", "osm_id"])


def grow_universe(spark: SparkSession, folder: str, output: str, checkpoint: str) -> StreamingQuery:
    """Append the identities that are new to ``output`` and stop; the checkpoint remembers files and keys."""
    rows = new_identities(identity_stream(spark, folder))
    return rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(output)
