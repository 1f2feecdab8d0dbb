import datetime as dt
import os
import tempfile

from retentio.plans import daily
from retentio.plans.defaults import AS_OF, today
from retentio.plans.registry import REGISTRY
from retentio.sources import sinks
from retentio.sources.tables import union_fill

SF = "/root/testdata/sf0.001"


def test_daily_batch_logs_a_failing_report_and_goes_on(spark, monkeypatch):
    def boom(m):
        raise RuntimeError("no such sheet")

    monkeypatch.setitem(REGISTRY, "boom", boom)
    out = tempfile.mkdtemp(prefix="/tmp/retentio-daily-")
    log = daily.run(spark, SF, out, keys=["monthly_kpis", "boom", "discount_mix"], by_country=("discount_mix",))
    assert [(r[1], r[2]) for r in log.rows] == [("monthly_kpis", "Correcto"), ("boom", "Error"), ("discount_mix", "Correcto")]
    assert log.failed == ["boom"]
    assert any(p.startswith("Country=") for p in os.listdir(os.path.join(out, "discount_mix")))
    got = {r.dataset: r for r in spark.read.parquet(os.path.join(out, "_run_log")).collect()}
    assert set(got) == {"monthly_kpis", "boom", "discount_mix"}
    assert "no such sheet" in got["boom"].error and got["monthly_kpis"].rows > 0


def test_daily_batch_reports_on_the_given_day(spark):
    out = tempfile.mkdtemp(prefix="/tmp/retentio-daily-")
    day = dt.date(2000, 3, 10)
    log = daily.run(spark, SF, out, keys=["fx_normalize"], as_of=day)
    assert [r[:3] for r in log.rows] == [(day, "fx_normalize", "Correcto")] and today() == AS_OF
    months = {r.Month for r in spark.read.parquet(f"{out}/fx_normalize").collect()}
    assert "2000-03" in months and all(m <= "2000-03" for m in months)


def test_sinks_sort(spark):
    out = tempfile.mkdtemp(prefix="/tmp/retentio-sinks-")
    df = spark.createDataFrame([("b", 2), ("a", 3), ("c", 1)], "Country string, n long").repartition(3)
    assert sinks.key_order(df) == ["Country"]
    sinks.write_csv(df.coalesce(1), f"{out}/csv", sort=["Country"])
    assert sinks.written_rows(spark, f"{out}/csv", "csv") == 3
    names = sorted(f for f in os.listdir(f"{out}/csv") if f.endswith(".csv"))
    lines = [x for f in names for x in open(f"{out}/csv/{f}").read().split() if not x.startswith("Country")]
    assert lines == ["a,3", "b,2", "c,1"]


def test_union_fill_appends_rows_lacking_columns(spark):  # SE3
    a = spark.createDataFrame([("x", 1, "k")], "Campaign string, n int, Month string")
    b = spark.createDataFrame([("y",)], "Campaign string")
    rows = {r.Campaign: r for r in union_fill([a, b], fill="-").collect()}
    assert rows["y"].Month == "-" and rows["y"].n is None
