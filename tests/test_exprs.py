import datetime as dt

from pyspark.sql import functions as F

from retentio.functions import exprs as X


def test_monday_week_matches_percent_w(spark):  # SF18 / T12
    start = dt.date(2019, 12, 25)
    days = [start + dt.timedelta(days=i) for i in range(900)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: r["w"] for r in df.select("d", X.monday_week("d").alias("w")).collect()}
    for d in days:
        assert got[d] == int(d.strftime("%W")), d
    assert got[dt.date(2021, 1, 1)] == 0


def test_month_and_hour_boundaries(spark):  # SF15, SF16
    df = spark.createDataFrame([(dt.datetime(2021, 1, 31, 23, 59), dt.datetime(2021, 2, 1, 0, 1))], "a timestamp, b timestamp")
    r = df.select(X.months_between_boundaries(F.to_date("a"), F.to_date("b")).alias("m"),
                  X.hours_between_boundaries("a", "b").alias("h")).collect()[0]
    assert r["m"] == 1 and r["h"] == 1


def test_clean_number_band_concat_like(spark):
    df = spark.createDataFrame([(float("nan"), None, "a", None, "X_Y"), (float("inf"), 3.0, "b", "c", "XAY")],
                               "x double, f double, s1 string, s2 string, name string")
    rows = df.select(X.clean_number("x").alias("c"), X.band("f", [2, 4], ["1-2", "3-4", "+"]).alias("b"),
                     X.key_concat("s1", "s2").alias("k"), X.not_like_any("name", ["%X_Y%"]).alias("keep")).collect()
    assert [r["c"] for r in rows] == [0.0, 0.0]
    assert [r["b"] for r in rows] == ["+", "3-4"]        # null falls to the last branch (T3)
    assert [r["k"] for r in rows] == [None, "b-c"]       # CONCAT with a null is null (T11)
    assert [r["keep"] for r in rows] == [False, False]   # '_' is a wildcard (FLT3)


def test_weekday_weight(spark):
    df = spark.createDataFrame([(dt.date(2021, 7, 16),), (dt.date(2021, 7, 19),)], "d date")  # Friday, Monday
    assert [r[0] for r in df.select(X.weekday_weight("d")).collect()] == [1.4, 1.0]
