"""Driver contract: entry() runs; every query matches its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from addrweave.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["import_id", "tags_text", "lon", "lat"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple("NULL" if r[i] is None else repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("nation", "customer", "supplier", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    srows = [tuple(r) for r in df.collect()]
    assert _norm(srows, df.columns) == _norm(drows, dcols)
