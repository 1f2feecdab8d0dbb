"""The state of every user at the end of a month, and how a month extends it.

Reports on lapsed users and first trials ask about a user's whole past: when the
last order was, whether there was an order of some vertical before. The state keeps
that, one row per user and country. A month's run aggregates the month's own orders
(and, for the discount ratio, the 181 days before them), merges them into the state
before, and the reports read the state and their own month only. Merging is one
aggregation with map-side combine; no report shuffles the history of all orders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import windows as W

KEYS = ["user_id", "country_name"]
#: Days before the last order that the discount ratio covers.
ADR_DAYS = 181
#: Verticals that are not "quick commerce" (excluded from trials).
NOT_QC = ["Restaurant", "Coffee", "Courier", "Courier Business"]


def _confirmed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == "CONFIRMED")


def _counts(orders: DataFrame, excluded) -> DataFrame:
    day = F.col("registered_date")
    return orders.groupBy(*KEYS).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.max(F.when(F.col("has_lines"), day)).alias("last_lined"), F.count(F.lit(1)).alias("orders"),
        F.count(F.when(~F.col("business_type_name").isin(excluded), 1)).alias("quick"))


def _with_tail(counts: DataFrame, orders: DataFrame) -> DataFrame:
    """``counts`` with the orders of the month of the last order, and the voucher discounts
    and payments of the ``ADR_DAYS`` before the last order up to the end of its month."""
    day, last = F.col("registered_date"), F.col("last_day")
    j = orders.join(counts.select(*KEYS, "last_day"), KEYS).filter(day.between(F.date_sub(last, ADR_DAYS), F.last_day(last)))
    tail = j.groupBy(*KEYS).agg(
        F.count(F.when(day >= F.trunc(last, "MM"), 1)).alias("freq"), F.sum("voucher_discount_amount").alias("vouchers"),
        F.sum(F.col("shipping_amount_no_discount") + F.col("amount_no_discount")).alias("paid"))
    return counts.join(tail, KEYS).withColumn("tail", F.struct("freq", "vouchers", "paid")).drop("freq", "vouchers", "paid")


def full_state(orders: DataFrame, until: dt.date, excluded=NOT_QC) -> DataFrame:
    """The state at the end of ``until``, from all orders: the first build."""
    o = _confirmed(orders).filter(F.col("registered_date") <= F.lit(until))
    if "order_month" in o.columns:
        o = o.filter(F.col("order_month") <= F.trunc(F.lit(until), "MM"))
    return _with_tail(_counts(o, excluded), o)


def extended(state: DataFrame, orders: DataFrame, month: dt.date, excluded=NOT_QC) -> DataFrame:
    """The state at the end of ``month``, from the state at the end of the month before."""
    first, last = W.first_of_month(month), W.last_of_month(month)
    of_month = _counts(_confirmed(X.in_window(orders, first, last)), excluded)
    new = _with_tail(of_month, _confirmed(X.in_window(orders, first - dt.timedelta(days=ADR_DAYS), last)))
    return state.unionByName(new).groupBy(*KEYS).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.max("last_lined").alias("last_lined"),
        F.sum("orders").alias("orders"), F.sum("quick").alias("quick"), F.max_by("tail", "last_day").alias("tail"))


def state_before(m, month: dt.date, excluded=NOT_QC) -> DataFrame:
    """The state at the end of the month before ``month``: the stored one where the model keeps it."""
    until = W.first_of_month(month) - dt.timedelta(days=1)
    if list(excluded) == NOT_QC and hasattr(m, "user_state"):
        return m.user_state(until)
    return full_state(m.orders(), until, excluded)


def quick_before(m, start: dt.date, as_of: dt.date, excluded=NOT_QC) -> DataFrame:
    """Per user and country the orders of quick verticals before ``start``, acquisitions on any day
    before ``as_of`` included: the state, and the orders from the month of ``start`` on."""
    o = _confirmed(X.in_window(m.orders(), W.first_of_month(start), as_of - dt.timedelta(days=1)))
    o = o.filter(((F.col("registered_date") < F.lit(start)) | (F.col("is_acquisition") == 1)) & ~F.col("business_type_name").isin(excluded))
    recent = o.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("quick"))
    past = state_before(m, start, excluded).filter("quick > 0").select(*KEYS, "quick")
    return past.unionByName(recent).groupBy(*KEYS).agg(F.sum("quick").alias("qc"))
