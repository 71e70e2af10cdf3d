"""Every query with SQL of its own, on the smallest data: the same rows from Spark and DuckDB."""

import os

import duckdb
import pytest

from gridjobs.jobs.files import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(df):
    df = df.copy()
    for c in df:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda x: None if x is None or x != x else str(x))
        else:
            df[c] = df[c].astype(float).round(4) + 0.0
    df = df[sorted(df)]
    return df.sort_values(list(df)).reset_index(drop=True)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    a, b = plain(QUERIES[name](spark, DATA).toPandas()), plain(con.execute(ORACLES[name]).df())
    assert list(a) == list(b)
    assert a.equals(b)
