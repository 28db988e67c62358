"""Tables whose rows are those that a manifest lists, on any store that Spark reads and writes.

A commit needs no rename of what readers see. Rows go to a folder of their own (``parts/<attempt>``), whatever becomes of the job; then one
small file, the manifest of the next version, names the files that count, with the rows and metrics that were observed while they were
written. Readers take the highest version that is whole and open what it lists, nothing else: files of killed jobs and of attempts that
lost are never listed, so none of their rows is seen. Two writers of one version can't both publish: the second is told.

A table may be bucketed: then its files keep Spark's bucket numbers, and joins and aggregates on the bucket columns read it without an exchange.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CommitConflictError(RuntimeError):
    """Another writer published the version first."""


@dataclass(frozen=True, slots=True)
class Buckets:
    """How many buckets a table has, and by which columns."""

    number: int
    keys: tuple[str, ...]


@dataclass(frozen=True, slots=True)
class Version:
    """One published state of a table."""

    number: int
    folder: str
    files: tuple[tuple[str, int], ...]
    schema: T.StructType
    row_count: int
    buckets: Buckets | None = None
    metrics: dict[str, int] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)

    def to_json(self) -> str:
        buckets = {"number": self.buckets.number, "keys": list(self.buckets.keys)} if self.buckets else None
        listed = [{"name": name, "size_bytes": size} for name, size in self.files]
        return json.dumps({"version": self.number, "folder": self.folder, "files": listed, "schema": self.schema.jsonValue(), "row_count": self.row_count, "buckets": buckets, "metrics": self.metrics, "facts": self.facts}, indent=2, sort_keys=True) + "\n"

    @classmethod
    def from_json(cls, text: str) -> Version | None:
        """None for what is not a whole manifest, such as one that is still being written."""
        try:
            found = json.loads(text)
            buckets = Buckets(found["buckets"]["number"], tuple(found["buckets"]["keys"])) if found["buckets"] else None
            files = tuple((f["name"], f["size_bytes"]) for f in found["files"])
            return cls(found["version"], found["folder"], files, T.StructType.fromJson(found["schema"]), found["row_count"], buckets, found["metrics"], found["facts"])
        except (ValueError, KeyError, TypeError):
            return None


class Store:
    """Files of one root through Hadoop's file system, as Spark itself reaches them."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def listed(self, folder: str) -> dict[str, int]:
        """Names and sizes of a folder's entries; none if it is absent."""
        path = self._path(folder)
        return {s.getPath().getName(): s.getLen() for s in self._fs.listStatus(path)} if self._fs.exists(path) else {}

    def text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Create a file; False if it is there already."""
        try:
            stream = self._fs.create(self._path(name), False)
        except Py4JJavaError as why:
            if "AlreadyExists" in why.java_exception.getClass().getName():
                return False
            raise
        stream.write(text.encode())
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class ManifestTable:
    """A table under ``root``: ``parts/`` with the rows of each attempt, ``manifests/`` with the versions."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.store = spark, Store(spark, root)

    def _numbers(self) -> list[int]:
        return sorted((int(m[1]) for n in self.store.listed("manifests") if (m := re.fullmatch(r"(\d{8})\.json", n))), reverse=True)

    def versions(self) -> list[Version]:
        """All whole versions, the latest first."""
        return [v for n in self._numbers() if (v := Version.from_json(self.store.text(f"manifests/{n:08d}.json")))]

    def latest(self) -> Version | None:
        for number in self._numbers():
            if found := Version.from_json(self.store.text(f"manifests/{number:08d}.json")):
                return found
        return None

    def write(self, df: DataFrame, *, buckets: Buckets | None = None, metrics: dict[str, Column] | None = None, facts: dict | None = None) -> Version:
        """Write ``df`` and publish it as the next version. ``metrics`` are aggregates that are observed on the way; nothing is read again.

        Bucketed rows should already lie by bucket (:func:`bucketed`): each task then writes one file a bucket.
        """
        folder, seen = f"parts/{uuid.uuid4().hex}", Observation()
        number = next(iter(self._numbers()), 0) + 1
        rows = df.observe(seen, F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in (metrics or {}).items()])
        path = f"{self.store.root}/{folder}"
        if buckets:
            name = f"bucketed_{uuid.uuid4().hex}"
            rows.write.bucketBy(buckets.number, *buckets.keys).sortBy(*buckets.keys).option("path", path).option("compression", "zstd").saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")  # the entry alone; the files are not Spark's
        else:
            rows.write.option("compression", "zstd").parquet(path)
        got = seen.get
        files = tuple(sorted((n, size) for n, size in self.store.listed(folder).items() if n.startswith("part-")))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        version = Version(number, folder, files, schema, got.pop("row_count"), buckets, got, facts or {})
        if not self.store.put(f"manifests/{number:08d}.json", version.to_json()):
            self.store.delete(folder)
            raise CommitConflictError(f"version {number} of {self.store.root} was published by another writer")
        return version

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, the latest by default.

        A bucketed version is read by its buckets as long as its folder holds its files alone; with a stray file beside them the listed files are read, right but unbucketed.
        """
        version = version or self.latest()
        if version is None:
            raise FileNotFoundError(f"no version of {self.store.root} is published")
        if not version.files:
            return self.spark.createDataFrame([], version.schema)
        path = f"{self.store.root}/{version.folder}"
        there = {n: s for n, s in self.store.listed(version.folder).items() if not n.startswith(("_", "."))}
        if lost := [n for n, size in version.files if there.get(n) != size]:
            raise FileNotFoundError(f"files of {path} are gone or changed: {', '.join(lost)}")
        if version.buckets and len(there) == len(version.files):
            name, quoted = f"bucketed_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in version.buckets.keys)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted}) SORTED BY ({quoted}) INTO {version.buckets.number} BUCKETS LOCATION '{path}'")
            try:
                return self.spark.table(name)  # analysed: the plan has its files and buckets from here on
            finally:
                self.spark.sql(f"DROP TABLE {name}")
        return self.spark.read.schema(version.schema).parquet(*[f"{path}/{n}" for n, _ in version.files])

    def vacuum(self, keep: int = 1) -> int:
        """Delete the folders that none of the last ``keep`` versions lists, and older manifests; how many folders went. Not while a writer is at work: its rows are listed by none yet."""
        kept = self.versions()[:keep]
        if not kept:
            return 0
        for number in self._numbers():
            if number < kept[-1].number:
                self.store.delete(f"manifests/{number:08d}.json")
        unlisted = {f"parts/{n}" for n in self.store.listed("parts")} - {v.folder for v in kept}
        for folder in unlisted:
            self.store.delete(folder)
        return len(unlisted)


def bucketed(df: DataFrame, buckets: Buckets) -> DataFrame:
    """``df`` dealt so that each partition is one bucket."""
    return df.repartition(buckets.number, *buckets.keys)
