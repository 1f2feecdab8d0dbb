"""Helpers shared by the operators: shared storage, running sums, word splitting."""

from __future__ import annotations

import gc
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space; a word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    A scratch folder is made only where the setting is unset and the master is
    local (tests); on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="retentio-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once an application: functions that run
    there import it, and executors need not have it installed."""
    sc = spark.sparkContext
    if not getattr(sc, "_retentio_shipped", False):
        root = pathlib.Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='retentio-code-')}/retentio.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(archive)
        sc._retentio_shipped = True
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: later stages start from
    files that outlive an executor, and nothing above them runs twice."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` returned and nothing reads any more."""
    _delete(df.sparkSession, df._stored_at)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps: its cleaner acts when
    the driver collects its garbage, which may take half an hour on its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Delete what ``stored`` has written for this application; results that
    still read it must have been written before."""
    _delete(spark, shared_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bitmap_of(df: DataFrame, column: str, bits: int = 1 << 25) -> tuple[int, bytes]:
    """A bitmap of the low bits of a long column: 4 MB whatever the table's size.

    It only saves work: a value whose bit is 0 is not in the column, all others
    must be looked up. A table too large for it sets all bits and saves nothing.
    """
    low = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = df.groupBy(F.shiftright(low, 6).cast("int").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast({column} & 63 as int)))").alias("bits"))
    out = np.zeros(bits // 64, dtype=np.int64)
    found = words.toArrow()  # one row per 64 bits at most
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bits, out.tobytes()


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running(df: DataFrame, order: Sequence[Column], value: str, out: str, name: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to this one in ``order``.

    Rows are dealt by ranges of ``order`` and stored; each range is summed by a
    window of its own, and the totals of the ranges (one row each) give the
    offsets. So no task sees more than one range, however many rows there are.
    ``order`` should be total; rows that tie on all of it are interchangeable.
    """
    ranged = df.repartitionByRange(n_partitions(df.sparkSession), *order)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_total"))
    before = F.sum("_total").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("_range", F.coalesce(before, F.lit(0)).alias("_offset"))
    window = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(F.broadcast(offsets), "_range")  # one row per range
            .withColumn(out, F.sum(value).over(window) + F.col("_offset"))
            .drop("_range", "_offset"))
