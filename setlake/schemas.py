"""Fixed schemas of persisted tables. Every column is nullable, so that files compare equal whoever wrote them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

KEY = ("osm_type", "osm_id")
IDENTITY = T.StructType().add("osm_type", "string").add("osm_id", "long")
MEMBERSHIP = IDENTITY
OVERLAP = T.StructType().add("osm_type", "string").add("osm_id", "long").add("website", "boolean").add("wikidata", "boolean").add("overlap_category", "string")
SUMMARY = T.StructType().add("overlap_category", "string").add("count", "long").add("percentage", "double")

#: Columns that each source must have; others are ignored.
WEBSITE_COLUMNS = ("osm_type", "osm_id", "website_text_status", "website_text", "contact_website_text_status", "contact_website_text")
LINK_COLUMNS = ("project", "document_id", "osm_type", "osm_id")
DOCUMENT_COLUMNS = ("project", "document_id", "fetch_status", "full_text")


def arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cast to ``schema`` with nullable columns, in its order; its partitions keep their numbers."""
    cast = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    if all(f.nullable for f in cast.schema):
        return cast
    return cast.unionByName(df.sparkSession.createDataFrame([], schema))  # a union is nullable if one side is
