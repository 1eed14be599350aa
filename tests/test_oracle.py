"""Every named query against its DuckDB SQL on the driver's small tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from funnelspark.plans.queries import ORACLES, QUERIES
from tools.check_oracle import TABLES, digest

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_id"


def test_every_query_has_oracle_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == set()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:2], sorted(set(ld) - set(ls))[:2])
