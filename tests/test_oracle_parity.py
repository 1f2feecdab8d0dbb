"""Every registered query against its DuckDB oracle on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as E
from retentio.plans.registry import REGISTRY
from tools.check import TABLES, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries()) and set(REGISTRY) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF).toPandas()
    odf = duck.execute(E.oracle_sql()[key]).df()
    sc, sr = rows(sdf, False)
    oc, orr = rows(odf, False)
    assert sc == oc
    assert len(sr) == len(orr)
    _, sr6 = rows(sdf, True)
    _, or6 = rows(odf, True)
    assert sr6 == or6


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "Country" in df.columns
