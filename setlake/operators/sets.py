"""Membership sets: which keys have successful text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlake.functions import predicates as P
from setlake.schemas import KEY


def distinct_keys(rows: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """The set of keys of ``rows``: partial aggregation in each task, then one shuffle of keys."""
    return rows.select(*key).distinct()


def website_members(pages: DataFrame) -> DataFrame:
    """Keys with a successful, non-blank text in either of two status and text pairs."""
    pairs = ((F.col("website_text_status"), F.col("website_text")), (F.col("contact_website_text_status"), F.col("contact_website_text")))
    kept = pages.filter(F.col("osm_type").isin(*P.ENTITY_TYPES)).filter(P.any_successful(*pairs, ok="success"))
    return distinct_keys(kept.withColumn("osm_id", F.col("osm_id").cast("bigint")))


def linked_members(links: DataFrame, documents: DataFrame, key: tuple[str, ...] = KEY, on: tuple[str, ...] = ("project", "document_id")) -> DataFrame:
    """Keys of links to at least one document: a semi join, so links to many documents don't multiply."""
    return distinct_keys(links.join(documents.select(*on), list(on), "left_semi"), key)


def wikidata_members(links: DataFrame, documents: DataFrame, provenance: Column | None = None) -> DataFrame:
    """Keys linked to an ok, non-blank document of a supported project; ``provenance`` restricts the links further."""
    wanted = links.filter(F.col("project").isin(*P.PROJECTS) & F.col("osm_type").isin(*P.ENTITY_TYPES))
    if provenance is not None:
        wanted = wanted.filter(provenance)
    ok = documents.filter(F.col("project").isin(*P.PROJECTS)).filter(P.successful(F.col("fetch_status"), F.col("full_text"), "ok"))
    return linked_members(wanted.withColumn("osm_id", F.col("osm_id").cast("bigint")), ok)
