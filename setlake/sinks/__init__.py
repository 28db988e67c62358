"""Atomic files, canonical shards and single-file Parquet."""
