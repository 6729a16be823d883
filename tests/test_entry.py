"""Driver contract: entry() smoke run and Spark == DuckDB oracle on every query."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlake import oracle, registry
from tests.conftest import SF_SMOKE

TABLES = ["customer", "orders", "lineitem"]


def test_entry_returns_gold_user_metrics(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["user_id", "name", "email"]
    assert df.count() == 142


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracle.SQL)
    assert set(registry.QUERIES) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMOKE)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    o_cols, o_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows
