"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_file
from checks.compare import normal

QUERIES, ORACLE = entry_file.QUERIES, entry_file.ORACLE


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(ORACLE) >= set(QUERIES)
    assert set(entry_file.queries()) >= set(QUERIES) and set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns[:3] == ["persistence_id", "highest_seq_nr", "snapshot_seq"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, found.fetchall())
