"""Every registered query against its DuckDB oracle on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    idx = [ocols.index(c) for c in order]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sheet_name", "field", "test_type", "test_name", "status", "failed_count"]
    assert df.count() > 0
