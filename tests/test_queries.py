"""Every core query runs on sf0.001; those with SQL agree with DuckDB row for row."""

from collections import Counter

import duckdb
import pytest

from graphloom import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, data, con, name):
    df = catalog.queries()[name](spark, data)
    cols = sorted(df.columns)
    rows = Counter(repr(tuple(r)) for r in df.select(*cols).collect())
    if sql := catalog.oracle_sql().get(name):
        names = ", ".join(f'"{c}"' for c in cols)
        assert rows == Counter(map(repr, con.execute(f"SELECT {names} FROM ({sql})").fetchall()))
    else:
        assert rows
