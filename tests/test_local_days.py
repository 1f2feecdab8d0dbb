import datetime as dt

from pyspark.sql import functions as F

from retentio.functions import exprs as X

START, END = dt.date(2001, 5, 16), dt.date(2001, 7, 15)
# (created_at in UTC, zone, inside the window by the zone's day)
ROWS = [
    ("2001-05-15 23:30:00", "Europe/Madrid", True), ("2001-05-16 00:30:00", "America/Lima", False), ("2001-05-16 05:00:00", "America/Lima", True),
    ("2001-05-15 23:30:00", "UTC", False), ("2001-05-15 23:30:00", None, False), ("2001-05-16 00:00:00", None, True),
    ("2001-05-15 10:00:00", "Pacific/Kiritimati", True), ("2001-05-15 09:59:59", "Pacific/Kiritimati", False),
    ("2001-07-16 04:59:59", "America/Lima", True), ("2001-07-16 05:00:00", "America/Lima", False), ("2001-07-16 00:00:00", "UTC", False),
    ("2001-07-15 22:30:00", "Europe/Madrid", False), ("2001-07-16 11:59:59", "Etc/GMT+12", True), (None, "UTC", False),
]


def _frame(spark):
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(ROWS)], "id int, at string, timezone string, inside boolean")
    return rows.withColumn("created_at", F.to_timestamp("at")).withColumn("created_month", F.trunc("created_at", "MM"))


def test_zone_borders(spark):
    near = X.created_near(_frame(spark), START, END)
    got = {r.id for r in near.filter(X.made_on(START, END)).collect()}
    assert got == {k for k, r in enumerate(ROWS) if r[2]}
    open_end = {r.id for r in X.created_near(_frame(spark), START).filter(X.made_on(START)).collect()}
    assert open_end == got | {9, 10, 11}


def test_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "creations")
    _frame(spark).where("created_at is not null").write.partitionBy("created_month").parquet(path)
    out = X.created_near(spark.read.parquet(path), START, END).filter(X.made_on(START, END))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_month" in plan and "created_month" in plan
    assert out.count() == sum(r[2] for r in ROWS)
