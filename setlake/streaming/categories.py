"""Categories that follow their inputs: raw identities and both memberships as three streams of files, changes of category as the result.

State is kept by word of 64 neighbouring ids (see :mod:`setlake.operators.bitmaps`): three longs for the sets and a count of the changes told so
far, in RocksDB. What a trigger brings is merged within the word; each key of the universe whose flags are new or other than before is told once, with
the number of its change. Order does not matter: a member may come before or after its identity, and repeats change nothing. Keys with a null
are passed over; they belong to neither set for good.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from setlake.functions import predicates as P
from setlake.operators.bitmaps import _SETS, _words
from setlake.schemas import IDENTITY, KEY

CHANGES = "osm_type string, osm_id long, website boolean, wikidata boolean, change long"
_ALL = (1 << 64) - 1


class Categories(StatefulProcessor):
    """Merges the bits of a word and tells which keys changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("bits", "u long, a long, b long, changes long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        kind, word = key
        *before, changes = self.state.get() if self.state.exists() else (0, 0, 0, 0)
        now = [int(x) for x in before]
        for part in rows:
            now = [x | int(np.bitwise_or.reduce(part[s].to_numpy(np.int64))) for x, s in zip(now, _SETS, strict=True)]
        if now == [int(x) for x in before]:
            return
        old_u, old_a, old_b = (int(x) & _ALL for x in before)
        u, a, b = (x & _ALL for x in now)
        told = u & (~old_u | (a ^ old_a) | (b ^ old_b))
        self.state.update((*now, int(changes) + 1))
        bits = np.flatnonzero(np.unpackbits(np.array([told & _ALL], "<u8").view(np.uint8), bitorder="little"))
        flags = [np.unpackbits(np.array([x], "<u8").view(np.uint8), bitorder="little")[bits].astype(bool) for x in (a, b)]
        yield pd.DataFrame({"osm_type": kind, "osm_id": int(word) * 64 + bits.astype(np.int64), "website": flags[0], "wikidata": flags[1], "change": int(changes) + 1})

    def close(self) -> None:
        pass


def follow_categories(spark: SparkSession, raw: str, website: str, wikidata: str, output: str, checkpoint: str) -> StreamingQuery:
    """Take in all files that came since the last run and append the changes to ``output``."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    parts = [_words(spark.readStream.schema(IDENTITY).parquet(path), name, KEY) for name, path in zip(_SETS, (raw, website, wikidata), strict=True)]
    merged = reduce(DataFrame.unionByName, parts).groupBy("kind", "word")
    changes = merged.transformWithStateInPandas(Categories(), CHANGES, "Append", "None")
    return changes.writeStream.outputMode("append").format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(changes: DataFrame) -> DataFrame:
    """The classified rows as of the last change of each key."""
    last = changes.groupBy(*KEY).agg(F.max_by(F.struct("website", "wikidata"), "change").alias("last"))
    flagged = last.select(*KEY, "last.website", "last.wikidata")
    return flagged.withColumn("overlap_category", P.category(F.col("website"), F.col("wikidata")))


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Words in state and their bytes, as of the last trigger."""
    progress = query.lastProgress
    found = progress["stateOperators"][0] if progress and progress["stateOperators"] else {}
    return {"words": found.get("numRowsTotal", 0), "bytes": found.get("memoryUsedBytes", 0)}
