"""Source tables (SRC1, SRC6, SRC7).

Inputs are Parquet tables read lazily; nothing is collected. Date windows are
applied later as filters, which Catalyst pushes into the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, base: str, names=TEST_TABLES) -> dict[str, DataFrame]:
    """SRC1: one lazy DataFrame per table name."""
    return {n: read_table(spark, base, n) for n in names}


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """SRC7 / SE2: same-schema sources stacked by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_fill(frames: list[DataFrame], fill: str | None = None) -> DataFrame:
    """SE3: stack frames whose columns differ; missing string cells get ``fill``."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if fill is not None:
        string_cols = [f.name for f in out.schema.fields if f.dataType.simpleString() == "string"]
        out = out.fillna(fill, subset=string_cols)
    return out
