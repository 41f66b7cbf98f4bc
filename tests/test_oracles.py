"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from sensorlake.plans.registry import QUERIES
from tools.check_oracles import TABLES, digest

SF = os.environ.get("SENSORLAKE_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(QUERIES)  # operators beyond the library have tests of their own


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(res.columns, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 894  # hourly rows at sf0.001
