"""Two coupons on one order, and one coupon in two orders: orders count once."""

from pyspark.sql import functions as F

from retentio.operators.primitives import one_row_per_order


def test_orders_with_two_coupons_count_once(spark):
    rows = [(1, "A", "c1", 10, 1), (1, "A", "c2", 5, 1), (2, "A", "c1", 7, 0), (2, "B", "c3", 1, 0)]
    df = spark.createDataFrame(rows, "order_id long, campaign string, coupon_id string, used long, acq int")
    per = one_row_per_order(df, ["campaign"], ["acq"], {"used": F.col("used")})
    got = {r.campaign: (r.n, r.acq, r.used) for r in per.groupBy("campaign").agg(
        F.count("*").alias("n"), F.sum("acq").alias("acq"), F.sum("used").alias("used")).collect()}
    assert got == {"A": (2, 1, 22), "B": (1, 0, 1)}
