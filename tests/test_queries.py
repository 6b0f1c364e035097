"""Every registered query with SQL, run on the smallest tables and held against DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from obsledger.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows_of(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or (not isinstance(x, (str, list)) and pd.isna(x)):
            return "null"
        return f"{x:.9g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    cols = sorted(df.columns)
    return sorted(tuple(plain(x) for x in r) for r in df[cols].astype(object).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    want = con.execute(catalogue.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
