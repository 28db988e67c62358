from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from setlake.plans import catalogue


def compare(spark, query, sql: str, sf_dir: str) -> None:
    """Same columns and same rows, whatever their order."""
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    wanted = con.sql(sql)
    got = query(spark, sf_dir)
    assert sorted(got.columns) == sorted(wanted.columns)
    columns = sorted(got.columns)
    rows = lambda found, names: sorted((tuple(r[names.index(c)] for c in columns) for r in found), key=repr)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(wanted.fetchall(), wanted.columns)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, sf_dir, name):
    compare(spark, catalogue.queries()[name], catalogue.oracle_sql()[name], sf_dir)


@pytest.mark.parametrize("name", ["pbf_identities", "pbf_loose_rings", "ring_predicate", "overlap_summary", "stored_overlap_rows"])
def test_query_equals_sql_on_more_rows(spark, name):
    compare(spark, catalogue.queries()[name], catalogue.oracle_sql()[name], "/root/testdata/sf0.01")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 4
    assert set(entry.oracle_sql()) <= set(entry.queries())
