import datetime as dt

from pyspark.sql import functions as F

from retentio.session import cluster_conf
from retentio.sources.adapter import Model
from retentio.sources.tables import load_tables

SF = "/root/testdata/sf0.001"


def test_unnest_of_the_nested_orders_equals_the_flat_discounts(spark):  # SF29, T2
    m = Model(load_tables(spark, SF))
    nested = m.orders_nested()
    exploded = nested.select("order_id", F.explode("discounts").alias("d")).select("order_id", "d.*")
    flat = m.discounts()
    assert exploded.exceptAll(flat).count() == 0 and flat.exceptAll(exploded).count() == 0
    empty = nested.filter(F.size("discounts") == 0).count()
    kept = exploded.select("order_id").distinct().count()
    assert kept + empty == nested.count()      # orders without lines vanish from the UNNEST


def test_one_acquisition_per_user_and_first_confirmed(spark):
    m = Model(load_tables(spark, SF))
    o = m.orders()
    per_user = o.groupBy("user_id").agg(F.sum("is_acquisition").alias("a"))
    assert per_user.filter("a > 1").count() == 0
    bad = o.filter((F.col("is_acquisition") == 1) & (F.col("order_status") != "CONFIRMED")).count()
    assert bad == 0


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 << 40)               # 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)


def test_nested_orders_of_a_window(spark):
    m = Model(load_tables(spark, SF))
    start, end = dt.date(1996, 3, 10), dt.date(1996, 5, 20)
    key = lambda r: (r.order_id, sorted(map(str, r.discounts)))
    whole = m.orders_nested().where(F.col("registered_date").between(start, end))
    want = sorted(map(key, whole.collect()))
    assert want and sorted(map(key, m.orders_nested(start, end).collect())) == want
