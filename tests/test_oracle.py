"""Every registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

from __future__ import annotations

from decimal import Decimal

import duckdb
import pytest

from conftest import SF01
from ratebook.sources.tables import TABLES

from ratebook.plans.catalog import QUERIES

import __spark_entry__ as entry_mod


def _norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, Decimal):
        return str(v.normalize())
    return str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF01)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    cur = duck.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = _rows(cur.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and len(df.columns) == 10


@pytest.mark.parametrize("name", ["local_run_stamp", "month_end", "erp_layout_v", "call_metrics"])
def test_time_zone_independent(spark, duck, name):
    """Timestamps are zone-less, so the session time zone must not matter."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = entry_mod.queries()[name](spark, SF01)
        got = _rows([tuple(r) for r in df.collect()], df.columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = duck.execute(entry_mod.oracle_sql()[name])
    assert got == _rows(cur.fetchall(), [d[0] for d in cur.description])
