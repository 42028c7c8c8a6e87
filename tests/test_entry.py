"""Driver contract and oracle agreement of every registered query (sf0.001)."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
os.environ.setdefault("CHECK_EXACT", "1")  # doubles must match DuckDB's bit for bit
import __spark_entry__ as E  # noqa: E402
from check_oracle import canon  # noqa: E402
from rateweave.sources.views import TABLES  # noqa: E402

NAMES = sorted(E.queries())


def test_contract(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_range_sum_matches_closed_form(spark):
    n = E.queries()["distinct_users"](spark, SF_SMALL).count()
    assert E.queries()["range_sum"](spark, SF_SMALL).first()[0] == n * (n + 1) // 2


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(ocols, orows)
