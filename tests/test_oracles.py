"""Queries beside their SQL on the smallest tables (tools/oracle.py does it for all of them)."""

from __future__ import annotations

import duckdb
import pytest

from loomgraph.plans import registry
from tools.oracle import TABLES, rows

CASES = [(m, k) for m in registry.modules() for k in m.oracle_sql()]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize(("module", "name"), CASES, ids=[k for _, k in CASES])
def test_query_equals_its_sql(spark, sf, con, module, name):
    df = module.queries()[name](spark, sf)
    cur = con.execute(module.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cur.fetchall())
