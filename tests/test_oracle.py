"""Every registered query against its DuckDB oracle on the smallest given tables."""

import datetime as dt
import json
import math

import duckdb
import pytest

import __spark_entry__ as E
from nearfield.sources.tables import GIVEN_TABLES

from conftest import SF_SMALL

ORACLES = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if hasattr(v, "asDict"):
        return _norm(list(v.asDict().values()))
    if isinstance(v, dict):
        return _norm(list(v.values()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in GIVEN_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[name])
    want = _rows([c[0] for c in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(c[0] for c in cur.description)
    assert got == want


def test_every_base_query_has_an_oracle():
    from nearfield.plans import catalog

    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
