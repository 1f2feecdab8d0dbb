"""Sinks (SNK1-SNK4): replace a table, one output per key, CSV, and a run log.

All writes are distributed (no collect, no single-file coalesce). A table is written
beside the one it replaces and then takes its name, so a write that fails leaves the
last good table, and nobody reads half of one. A failed
report is recorded in the run log with its error; the batch goes on with the
next one and tells at its end that it has failed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def key_order(df: DataFrame) -> list[str]:
    """The text and date columns of a report, in their order: what it is sorted by (SO1, SO2)."""
    return [f.name for f in df.schema if f.dataType.typeName() in ("string", "date")]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def restore(spark: SparkSession, path: str) -> None:
    """Give a table its name back if a job died between the two renames of ``replace``."""
    fs, target = _fs(spark, path)
    _, last = _fs(spark, f"{path}.last")
    if fs.exists(last):
        if fs.exists(target):
            fs.delete(last, True)
        else:
            fs.rename(last, target)


def replace(spark: SparkSession, path: str, write) -> str:
    """``write(folder)`` beside ``path``; the new table takes the name when it is whole."""
    path = path.rstrip("/")
    folder, _, name = path.rpartition("/")
    staged = f"{folder}/.{name}-{uuid.uuid4().hex}" if folder else f".{name}-{uuid.uuid4().hex}"
    restore(spark, path)
    fs, target = _fs(spark, path)
    _, source = _fs(spark, staged)
    try:
        write(staged)
    except BaseException:
        fs.delete(source, True)
        raise
    _, last = _fs(spark, f"{path}.last")
    if fs.exists(target) and not fs.rename(target, last):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(source, target):
        fs.rename(last, target)
        raise OSError(f"cannot move {staged} to {path}")
    fs.delete(last, True)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", sort=()) -> str:
    """SNK1: replace the destination table; ``sort`` orders it by ranges over all files."""
    if sort:
        df = df.orderBy(*sort)
    if mode != "overwrite":
        df.write.mode(mode).format(fmt).save(path)
        return path
    return replace(df.sparkSession, path, lambda folder: df.write.format(fmt).save(folder))


def write_by_key(df: DataFrame, path: str, key: str = "Country", fmt: str = "parquet", sort=()) -> str:
    """SNK2: one output per key value in a single pass (the key becomes the folder name),
    each sorted by ``sort``."""
    if sort:
        df = df.orderBy(key, *[c for c in sort if c != key])
    return replace(df.sparkSession, path, lambda folder: df.write.partitionBy(key).format(fmt).save(folder))


def write_csv(df: DataFrame, path: str, sort=()) -> str:
    """SNK3: CSV with a header row (one file per partition)."""
    if sort:
        df = df.orderBy(*sort)
    return replace(df.sparkSession, path, lambda folder: df.write.option("header", True).csv(folder))


@dataclass
class RunLog:
    """SNK4: one row per dataset: run date, dataset, status, rows written, error."""

    run_date: dt.date
    rows: list = field(default_factory=list)

    def record(self, dataset: str, status: str, n_rows: int | None = None, error: str | None = None):
        self.rows.append((self.run_date, dataset, status, n_rows, error))

    @property
    def failed(self) -> list[str]:
        return [r[1] for r in self.rows if r[2] != "Correcto"]

    def publish(self, spark: SparkSession, path: str) -> DataFrame:
        """Append this run's entries to the log table."""
        df = spark.createDataFrame(self.rows, "run_date date, dataset string, status string, rows long, error string")
        df.write.mode("append").parquet(path)
        return df


def written_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Row count of a written table (for Parquet answered from file footers)."""
    return spark.read.format(fmt).option("header", True).load(path).count()
