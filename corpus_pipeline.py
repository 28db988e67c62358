"""The corpus pipeline: language ID, exact dedup, near-dedup, secret scan, packing.

Each stage is one operator over all that the stage before it kept, and its docstring states the operator's results for odd rows.
Here: documents with a null or empty text, or one without a letter, go at the first stage; with no labelled row at all no language is
known and every document goes; very long texts are whole at every stage, and are cut into sequences only by the last; ids that are null or shared are
documents of their own; columns of any name pass through up to the last stage; an empty table packs into nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from setlake.llm import catalogue, exact_dedup, langid, packing, secrets, simhash
from setlake.llm.common import drop_scratch, materialise

#: Tokens of a packed sequence.
SEQUENCE = 2048


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return langid.keep_identified(docs, langid.learn(docs, ~langid.held_out()))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked the one with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence."""
    return packing.pack(docs, catalogue.TOKENIZER_JSON, SEQUENCE)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

#: Profiles, fingerprints and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name)
        drop_scratch(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
