"""Every catalog query against its DuckDB form."""

import duckdb
import pandas as pd
import pytest

from chunkwright import catalog_queries

QUERIES, ORACLES = catalog_queries.queries(), catalog_queries.oracle_sql()


def _plain(v):
    if v is None or v is pd.NaT or v != v:
        return "NULL"
    return pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in catalog_queries.COLUMNS:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    names = sorted(got.columns)
    rows = sorted(tuple(_plain(r[c]) for c in names) for r in got.collect())
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == names
    at = [want.columns.index(c) for c in names]
    assert rows == sorted(tuple(_plain(r[i]) for i in at) for r in want.fetchall())
    assert rows


def test_all_have_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_speed_of_events_with_nulls(spark, tmp_path):
    """Events without run, time, type or bytes, and runs that begin with unknown bytes, are what they are in SQL."""
    cases = "CASE WHEN i % 31 <> 3 THEN timestamp '2024-01-01' + to_minutes(i * 37) END AS ts, CASE WHEN i % 29 <> 4 THEN i END AS user_id, CASE WHEN i % 23 > 1 THEN ['click', 'purchase', 'error', 'view', 'signup'][1 + i % 5] END AS event_type, CASE WHEN i > 40 AND i % 7 > 0 THEN CAST(i * 0.37 AS DOUBLE) END AS value"
    con = duckdb.connect()
    con.sql(f"COPY (SELECT i AS event_id, {cases} FROM range(600) r(i)) TO '{tmp_path}/events.parquet'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.sql(ORACLES["q_rolling_speed"])
    got = QUERIES["q_rolling_speed"](spark, str(tmp_path)).select(*want.columns)
    rows = sorted(tuple(map(_plain, r)) for r in got.collect())
    assert rows == sorted(tuple(map(_plain, r)) for r in want.fetchall()) and len(rows) == 600
