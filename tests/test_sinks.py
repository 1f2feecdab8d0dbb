import datetime as dt
import os
import tempfile

import pytest

from retentio.sources import sinks


def test_write_by_key_and_run_log(spark):
    out = tempfile.mkdtemp(prefix="/tmp/retentio-test-")
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "Country string, v int")
    sinks.write_by_key(df, os.path.join(out, "t"))
    assert sorted(p for p in os.listdir(os.path.join(out, "t")) if p.startswith("Country=")) == ["Country=A", "Country=B"]
    log = sinks.RunLog(dt.date(2021, 7, 15))
    log.record("t", "Correcto", sinks.written_rows(spark, os.path.join(out, "t")))
    log.publish(spark, os.path.join(out, "_log"))
    got = spark.read.parquet(os.path.join(out, "_log")).collect()
    assert [(r.dataset, r.status, r.rows) for r in got] == [("t", "Correcto", 3)]


def test_a_failed_write_keeps_the_last_table(spark):
    path = tempfile.mkdtemp(prefix="/tmp/retentio-test-") + "/t"
    yesterday = spark.createDataFrame([("A", 1)], "Country string, v int")
    sinks.write_table(yesterday, path)
    broken = spark.createDataFrame([("A", 1), ("B", 0)], "Country string, v int").selectExpr("Country", "if(v = 0, raise_error('stopped'), v) AS v")
    for write in (sinks.write_table, sinks.write_by_key, sinks.write_csv):
        with pytest.raises(Exception, match="stopped"):
            write(broken, path)
        assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("A", 1)]
    assert os.listdir(os.path.dirname(path)) == ["t"]     # nothing half-written is left
    sinks.write_table(spark.createDataFrame([("C", 3)], "Country string, v int"), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("C", 3)]


def test_a_table_moved_aside_is_restored(spark):
    path = tempfile.mkdtemp(prefix="/tmp/retentio-test-") + "/t"
    sinks.write_table(spark.createDataFrame([("A", 1)], "Country string, v int"), path)
    os.rename(path, path + ".last")                       # a job that died between the two renames
    sinks.restore(spark, path)
    assert spark.read.parquet(path).count() == 1
