"""Every registered query against its DuckDB oracle (values compared exactly,
columns by name, rows as a multiset)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# the corpus operators have their own tests
QUERIES = {k: f for k, f in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLE = {k: s for k, s in entry.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_model_based():
    rows_only = set(QUERIES) - set(ORACLE)
    assert not rows_only
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, s_rows) == _canon(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["churn_label", "segment", "balance", "order_count", "user_tenure"]
