import duckdb
import pytest

from retentio.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(registry.SQL))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.SQL[key]).df()
    got = registry.QUERIES[key](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    rows = lambda df: sorted(map(tuple, df[order].astype(str).values.tolist()))
    assert rows(got) == rows(want)


def test_every_operator_is_registered():
    assert {k.split("_")[0] for k in registry.QUERIES} == {f"op{n}" for n in range(1, 14)}
