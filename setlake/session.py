"""The session that the command line uses, and the shared folder of any session."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

#: Settings that results depend on (ANSI, UTC) or that every plan here profits from.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "setlake", master: str | None = None, **more: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``master`` is left to spark-submit where it is not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | more).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``, which all executors share; one of our own only where there is no cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return _own_dir()


@cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="setlake-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/setlake/{name}-{uuid.uuid4().hex}"
