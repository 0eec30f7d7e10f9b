"""Every registered query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from leafmill import catalog


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def rows(df):
    value = lambda x: None if pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted((tuple(map(value, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    mine, theirs = catalog.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(catalog.ORACLES[name]).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
