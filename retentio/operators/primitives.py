"""Generic relational building blocks used by the domain operators.

Each is a composition of DataFrame operations (no UDF). They exist because the
reference expresses them in a way Spark would plan badly (range and OR joins
become nested loops) or because several operators share them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def _day(c) -> Column:
    return F.datediff(F.col(c) if isinstance(c, str) else c, F.lit(EPOCH).cast("date"))


def bucketed_range_join(left: DataFrame, right: DataFrame, key: str, lo, hi, point: str,
                        bucket_days: int = 64, how: str = "inner") -> DataFrame:
    """JN5: rows of ``right`` whose ``point`` date lies in [lo, hi] of a ``left`` row with the same key.

    Spark plans a join on ``key`` plus a range as an equi join on ``key``
    followed by a filter: a key that holds a large share of the rows (one heavy
    user) lands in one task and pairs with all of its rows. Here both sides
    are also keyed by a time bucket: ``right`` rows go to the bucket of their
    date, ``left`` rows are repeated once per bucket their interval touches
    (ceil(width / bucket_days) + 1 copies at most). The equi join on
    (key, bucket) spreads one key over many tasks, AQE can still split skewed
    (key, bucket) partitions, and every matching pair is produced exactly once.
    ``lo``/``hi`` are column names or Columns (dates).
    """
    lo_c = F.col(lo) if isinstance(lo, str) else lo
    hi_c = F.col(hi) if isinstance(hi, str) else hi
    b = F.lit(bucket_days)
    lft = left.withColumn("_lo", lo_c).withColumn("_hi", hi_c).withColumn(
        "_b", F.explode(F.sequence(F.floor(_day("_lo") / b), F.floor(_day("_hi") / b))))
    rgt = right.withColumn("_b", F.floor(_day(point) / b))
    j = lft.join(rgt, [key, "_b"], how)
    cond = F.col(point).between(F.col("_lo"), F.col("_hi"))
    return j.filter(cond).drop("_b", "_lo", "_hi")


def explode_validity(df: DataFrame, start, end, lo, hi, name: str = "d") -> DataFrame:
    """JN7: one row per day of an open-ended validity interval, clipped to [lo, hi].

    ``start``/``end`` are date columns (``end`` may be null = open). The
    clipped interval turns the range join against a calendar into an equi
    join on the day, so no nested-loop join is planned.
    """
    s = F.greatest(F.col(start) if isinstance(start, str) else start, F.lit(lo))
    e = F.least(F.coalesce(F.col(end) if isinstance(end, str) else end, F.lit(hi)), F.lit(hi))
    return df.filter(s <= e).withColumn(name, F.explode(F.sequence(s, e)))


def explode_months(df: DataFrame, start, end, lo, hi, month: str, days: str) -> DataFrame:
    """JN7: one row per month that an open-ended interval of days touches, clipped to
    [lo, hi], with the number of its days there; a month has one row, not 30."""
    s = F.greatest(F.coalesce(F.col(start) if isinstance(start, str) else start, F.lit(lo)), F.lit(lo))
    e = F.least(F.coalesce(F.col(end) if isinstance(end, str) else end, F.lit(hi)), F.lit(hi))
    rows = df.withColumn("_s", s).withColumn("_e", e).filter("_s <= _e")
    rows = rows.withColumn(month, F.explode(F.sequence(F.trunc("_s", "MM"), F.trunc("_e", "MM"), F.expr("interval 1 month"))))
    last, first = F.least(F.last_day(month), F.col("_e")), F.greatest(F.col(month), F.col("_s"))
    return rows.withColumn(days, F.datediff(last, first) + 1).drop("_s", "_e")


def calendar(spark, start, end, name: str = "date") -> DataFrame:
    """SRC5: calendar dimension between two dates (one row per day)."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(name))


def month_grid(spark, start, end, name: str = "month") -> DataFrame:
    """Months (first days) between two dates, for densified grids."""
    return spark.range(1).select(
        F.explode(F.sequence(F.trunc(F.lit(start), "MM"), F.trunc(F.lit(end), "MM"),
                             F.expr("interval 1 month"))).alias(name))


def densify_months(keys: DataFrame, start, end, name: str = "month") -> DataFrame:
    """RS1: every key row repeated once per month of [start, end] (first days).

    The months come from ``sequence`` + ``explode`` on each key row: the grid
    grows by the fixed number of months of the window, with no join.
    """
    months = F.sequence(F.trunc(F.lit(start), "MM"), F.trunc(F.lit(end), "MM"), F.expr("interval 1 month"))
    return keys.withColumn(name, F.explode(months))


def with_previous_period(facts: DataFrame, keys: list[str], period: str, value: str, next_period,
                         last_period=None) -> DataFrame:
    """WN1 / WN7 without a dense grid: LAG(value, 1, 0) over the period sequence of each key.

    Each (key, period, value) row is emitted twice, as "this period" and as
    "previous period" of the next one; one aggregation merges them. The result
    holds every (key, period) where this or the previous period has a value,
    which are the only grid rows a densify + LAG would make non-zero.
    ``next_period`` maps the period column to the next period; rows shifted
    past ``last_period`` are dropped.
    """
    tm = facts.select(*keys, period, F.col(value).alias("tm"), F.lit(0).cast(facts.schema[value].dataType).alias("lm"))
    lm = facts.select(*keys, next_period(F.col(period)).alias(period), F.lit(0).cast(facts.schema[value].dataType).alias("tm"),
                      F.col(value).alias("lm"))
    if last_period is not None:
        lm = lm.filter(F.col(period) <= F.lit(last_period))
    both = tm.unionByName(lm)
    return both.groupBy(*keys, period).agg(F.sum("tm").alias(value), F.sum("lm").alias(f"{value}_lm"))


def prev_value(col: str, partition: list[str], order: str, default=0) -> Column:
    """WN1: LAG(col, 1, default) OVER (PARTITION BY ... ORDER BY order)."""
    return F.lag(col, 1, default).over(Window.partitionBy(*partition).orderBy(order))


def running_sum(col: str, partition: list[str], order: list) -> Column:
    """WN2: cumulative sum in a fixed order (rows frame)."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(col).over(w)


def share_of_group(col: str, partition: list[str]) -> Column:
    """WN4: x / sum(x) over the group."""
    return F.try_divide(F.col(col).cast("double"), F.sum(col).over(Window.partitionBy(*partition)).cast("double"))


def group_max(col: str, partition: list[str]) -> Column:
    """WN5 / JN18: group total or maximum on every row, without a join."""
    return F.max(col).over(Window.partitionBy(*partition))


def full_merge(frames: list[DataFrame], on: list[str], fill=None) -> DataFrame:
    """JN14 / JN15 / JN8: chain of full outer joins on the same keys; gaps filled."""
    out = reduce(lambda a, b: a.join(b, on, "full"), frames)
    if fill is not None:
        out = out.fillna(fill)
    return out


def coalesce_key(*cols) -> Column:
    """JN9: ``a = k OR b = k`` between two key columns that are never both set
    to different values becomes an equi join on coalesce(a, b)."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


def one_row_per_order(df: DataFrame, keys: list, flags: list[str], sums: dict) -> DataFrame:
    """One row per order and ``keys``: the flags (constant in an order) and the sums of
    ``sums`` (name -> column). Counting these rows counts distinct orders, however
    many coupons an order has, without the Expand of COUNT(DISTINCT ...)."""
    return df.groupBy("order_id", *keys).agg(*[F.max(c).alias(c) for c in flags], *[F.sum(v).alias(k) for k, v in sums.items()])
