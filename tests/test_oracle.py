"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402

from tidemark.plans import registry  # noqa: E402

registry.load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(registry.ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(c.lower() for c in s_cols) == sorted(c.lower() for c in d_cols)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
