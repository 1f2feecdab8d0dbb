"""Cohort family: D3-D6, D8 (campaign cohorts, cohort value, retention, mature
cohorts, ADR after campaign).

One engine serves all of them:

1. acquisition rows: a user's campaign order(s) on a day (with campaign keys);
2. follow-up orders pre-aggregated per (user, day, status): counts and sums;
3. a bucketed range join of 1 x 2 on the user and a day window
   (``primitives.bucketed_range_join``): the fan-out per acquisition row is
   bounded by the days in the window, never by the user's order count, and a
   heavy user is spread over many (user, bucket) keys;
4. day difference -> ORIGINALS / M1 (1-30) / M2 (31-60) / M3 (61-90);
5. two-stage aggregation: per (report keys, user) flags and sums, then per
   report keys counts of flagged users (no COUNT DISTINCT, no Expand).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import rules as R
from ..functions import windows as W
from . import primitives as P
from .spend import with_fx

BUCKETS = ("M1", "M2", "M3")


def _not_confirmed(status="order_status"):
    """CASE WHEN status != 'CONFIRMED' ...: a null status takes the ELSE branch."""
    return F.coalesce(F.col(status) != "CONFIRMED", F.lit(False))


def cohort_bucket(days) -> F.Column:
    d = F.col(days) if isinstance(days, str) else days
    return (F.when(d == 0, "ORIGINALS").when(d.between(1, 30), "M1").when(d.between(31, 60), "M2")
            .when(d.between(61, 90), "M3"))


def voucher_uses(m, created_from: dt.date, created_to: dt.date, traded_from: dt.date, traded_to: dt.date,
                 consumed_only: bool = True) -> DataFrame:
    """Voucher trades with their creation, both inside their window; one row per (voucher, order),
    however often a use was reported. Trades that only reserve a voucher count when asked for."""
    t = X.in_months(m.trades(), traded_from, traded_to).filter(F.to_date("traded_at").between(F.lit(traded_from), F.lit(traded_to)))
    if consumed_only:
        t = t.filter(F.col("type") == "CONSUME")
    t = t.select("coupon_id", "order_id", "amount_used").distinct()
    c = X.created_in(m.creations(), created_from, created_to)
    return t.join(c, "coupon_id").select(
        "order_id", F.col("campaign_name").alias("campaign"), "discount_type", F.col("discount_value").alias("discount_amount"),
        F.col("max_amount").alias("discount_max_amount"), "min_amount", "amount_used")


def _disc_per_order(m, start, end) -> DataFrame:
    """Discount totals per order from the repeated field; orders without rows vanish."""
    d = X.in_months(m.discounts(), start, end)
    amt = F.col("discount_amount")
    return d.groupBy("order_id").agg(
        F.sum(amt).alias("total_disc"),
        F.sum(F.when(F.upper("discount_type_name") == "VOUCHER", amt).otherwise(F.lit(0))).alias("total_voucher_disc"))


def follow_ups_daily(ot: DataFrame, metrics: list[str]) -> DataFrame:
    """Follow-up orders per (user, day, status): confirmed order count and confirmed sums."""
    nc = _not_confirmed()
    aggs = [F.count(F.when(~nc, 1)).alias("orders")]
    aggs += [F.sum(F.when(nc, F.lit(0)).otherwise(F.col(x))).alias(x) for x in metrics]
    return ot.groupBy("user_id", F.col("registered_date").alias("o_fecha"), "order_status").agg(*aggs)


def cohort_stats(acq: DataFrame, daily: DataFrame, acq_cols: list[str], report_keys: list,
                 metrics: list[str], hi, grain: str = "day_status", orders_name: str = "Orders",
                 original_amount: bool = True, acq_amounts: dict | None = None) -> DataFrame:
    """Steps 3-5 of the engine.

    ``acq`` has user_id, fecha, the columns ``acq_cols`` and ``acq_amount``
    (when ``original_amount``); ``hi`` is the last follow-up day (a Column).
    ``grain`` is the follow-up grouping of the reference: per (day, status)
    or per bucket; it decides how often Original_Amount_Used repeats (T20).
    """
    amounts = (acq_amounts or {"acq_amount": "Original_Amount_Used"}) if original_amount else {}
    j = P.bucketed_range_join(acq, daily, "user_id", "fecha", hi, "o_fecha")
    j = j.withColumn("cohort", cohort_bucket(F.datediff("o_fecha", "fecha")))
    if grain == "bucket":
        keep = ["user_id", "fecha", *acq_cols, *amounts]
        j = j.groupBy(*keep, "cohort").agg(F.sum("orders").alias("orders"), *[F.sum(x).alias(x) for x in metrics])
    ck = F.col("cohort")
    aggs = [F.max(F.when(ck == "ORIGINALS", 1).otherwise(0)).alias("_orig")]
    for b in BUCKETS:
        aggs.append(F.max(F.when((ck == b) & (F.col("orders") > 0), 1).otherwise(0)).alias(f"_u_{b}"))
        aggs.append(F.sum(F.when(ck == b, F.col("orders")).otherwise(F.lit(0))).alias(f"_o_{b}"))
        for x in metrics:
            aggs.append(F.sum(F.when(ck == b, F.col(x)).otherwise(F.lit(0))).alias(f"_m_{b}_{x}"))
    for i, a in enumerate(amounts):
        aggs.append(F.sum(a).alias(f"_oau{i}"))
    per_user = j.groupBy(*report_keys, "user_id").agg(*aggs)
    out = []
    for i, name in enumerate(amounts.values()):
        out.append(F.sum(f"_oau{i}").alias(name))
    out.append(F.sum("_orig").cast("long").alias("Acquisitions"))
    for b in BUCKETS:
        out.append(F.sum(f"_u_{b}").cast("long").alias(f"{b}_Users"))
        out.append(F.sum(f"_o_{b}").cast("long").alias(f"{b}_{orders_name}"))
    for b in BUCKETS:
        for x in metrics:
            out.append(F.sum(f"_m_{b}_{x}").alias(f"{b}_{METRIC_NAMES.get(x, x)}"))
    return per_user.groupBy(*report_keys).agg(*out)


METRIC_NAMES = {
    "revenue": "Revenue", "revenue_usd": "Revenue_USD", "total_paid": "Total_Paid", "total_paid_usd": "Total_Paid_USD",
    "total_disc": "Total_Disc", "total_disc_usd": "Total_Disc_USD",
    "total_voucher_disc": "Total_Voucher_Disc", "total_voucher_disc_usd": "Total_Voucher_Disc_USD",
    "amount_used": "Amount_Used", "amount_used_usd": "Amount_Used_USD",
}


def variation(amount="discount_amount", max_amount="discount_max_amount", mov="min_amount") -> F.Column:
    """SF2: 'Disc Amount: a - Max Amount: b - MOV: c'; null when any part is null."""
    return F.concat(F.lit("Disc Amount: "), F.col(amount).cast("string"), F.lit(" - Max Amount: "),
                    F.col(max_amount).cast("string"), F.lit(" - MOV: "), F.col(mov).cast("string"))


# ---------------------------------------------------------------- D3
def campaign_cohorts(m, as_of: dt.date, months_back: int = 3, max_days: int = 90) -> DataFrame:
    """D3: per campaign / city / month: acquisitions and M1-M3 returning users and orders.

    M3 ends on day 90: later follow-ups have no column here and are not joined."""
    b_from = W.first_of_month(W.add_months(as_of, -(months_back + 1)))
    b_to = W.first_of_month(as_of) - dt.timedelta(days=1)
    bt = voucher_uses(m, b_from, b_to, b_from, b_to)
    o_from = W.first_of_month(W.add_months(as_of, -months_back))
    ot = X.in_window(m.orders(), o_from, as_of)
    ot = ot.select("order_id", "user_id", F.col("country_name").alias("country"),
                   F.coalesce("city_name", F.lit("-")).alias("city"), "order_status", "registered_date")
    acq_cols = ["country", "city", "campaign", "discount_type", "discount_amount", "discount_max_amount", "min_amount"]
    acq = ot.join(bt, "order_id").select("user_id", F.col("registered_date").alias("fecha"), *acq_cols).distinct()
    daily = follow_ups_daily(ot, [])
    keys = [X.month_key("fecha").alias("Month"), F.col("country").alias("Country"), F.col("city").alias("City"),
            F.col("campaign").alias("Campaign"), F.col("discount_type").alias("Discount_Type"),
            F.col("discount_amount").alias("Amount"), F.col("discount_max_amount").alias("Max_Amount"),
            F.col("min_amount").alias("MOV")]
    # Spark resolves names case-insensitively: keep only the report names
    acq = acq.select("user_id", "fecha", *keys)
    names = ["Month", "Country", "City", "Campaign", "Discount_Type", "Amount", "Max_Amount", "MOV"]
    return cohort_stats(acq, daily, names, names, [], F.date_add("fecha", max_days),
                        orders_name="orders", original_amount=False)


def cohort_retention_rates(cohorts: DataFrame) -> DataFrame:
    """Retention Mx = Mx_Users / Acquisitions (null when there are no acquisitions)."""
    return cohorts.withColumns({f"Retention {b}": X.safe_ratio(f"{b}_Users", "Acquisitions") for b in BUCKETS})


# ---------------------------------------------------------------- D4
VOUCHER_METRICS = ["revenue", "total_paid", "total_paid_usd", "total_disc", "total_disc_usd",
                   "total_voucher_disc", "total_voucher_disc_usd", "amount_used", "amount_used_usd"]
VARIATION_METRICS = ["revenue", "revenue_usd", "total_paid", "total_paid_usd", "total_disc", "total_disc_usd",
                     "total_voucher_disc", "total_voucher_disc_usd", "amount_used", "amount_used_usd"]
COUPON_METRICS = ["total_paid", "total_disc", "total_voucher_disc"]


def campaign_cohort_value(m, as_of: dt.date, source: str = "voucher", exclude_like=(),
                          max_days: int = 180) -> DataFrame:
    """D3 plus revenue, paid, discount, voucher discount and used amount per bucket.

    ``source='voucher'``: voucher trades, follow-ups up to 180 days, local and
    USD, grouped per follow-up day and status; the variation text is a key
    and campaigns matching ``exclude_like`` are dropped.
    ``source='coupon'``: coupons of the last four months, follow-ups up to
    ``as_of``, local money only, grouped per bucket.
    ``source='variations'``: the voucher form plus revenue and the
    acquisition's used amount in USD.
    """
    variations = source == "variations"
    if variations:
        source = "voucher"
    if source == "voucher":
        win = W.first_of_month(W.add_months(as_of, -4))
        bt = voucher_uses(m, win, as_of, win, as_of)
        o_from = W.first_of_month(W.add_months(as_of, -3))
    else:
        o_from = W.first_of_month(W.add_months(as_of, -4))
        c = m.coupons().filter(F.col("order_id").isNotNull()
                               & F.col("order_registered_date").between(F.lit(o_from), F.lit(as_of)))
        bt = c.select("order_id", F.col("campaign_name").alias("campaign"), F.col("used_amount").alias("amount_used"))
    o = X.in_window(m.orders(), o_from, as_of)
    o = o.join(_disc_per_order(m, o_from, as_of), "order_id")
    paid = F.coalesce(F.col("shipping_amount_no_discount") + F.col("amount_no_discount"), F.lit(0))
    o = o.withColumns({
        "country": F.col("country_name"), "city": F.coalesce("city_name", F.lit("-")),
        "revenue": F.when(F.col("with_logistics"), F.col("commission_amount") + F.col("shipping_amount"))
                    .otherwise(F.col("commission_amount")),
        "total_paid": paid,
    })
    if source == "voucher":
        # an order counts once, whatever number of vouchers it used
        per_order = bt.groupBy("order_id").agg(F.sum("amount_used").alias("bt_used"))
        o = with_fx(o.join(per_order, "order_id", "left"), m)
        usd = lambda c: F.try_divide(F.col(c).cast("double"), F.col("rate_us"))
        o = o.withColumn("amount_used", F.coalesce("bt_used", F.lit(0)))
        o = o.withColumns({"total_paid_usd": usd("total_paid"), "total_disc_usd": usd("total_disc"),
                           "total_voucher_disc_usd": usd("total_voucher_disc"), "amount_used_usd": usd("amount_used"),
                           "revenue_usd": usd("revenue")})
        metrics = VARIATION_METRICS if variations else VOUCHER_METRICS
        acq_cols = ["country", "city", "campaign", "discount_type", "discount_amount", "discount_max_amount", "min_amount"]
    else:
        metrics = COUPON_METRICS
        acq_cols = ["country", "city", "campaign"]
    bt_cols = [c for c in acq_cols if c in bt.columns]
    extra = [F.sum("amount_used_usd").alias("acq_amount_usd")] if variations else []
    acq = (o.select("order_id", "user_id", "registered_date", "country", "city",
                    *(["amount_used_usd"] if variations else []))
           .join(bt.select("order_id", *bt_cols, F.col("amount_used").alias("_bt_used")), "order_id")
           .groupBy("user_id", F.col("registered_date").alias("fecha"), *acq_cols)
           .agg(F.sum("_bt_used").alias("acq_amount"), *extra))
    daily = follow_ups_daily(o, metrics)
    keys = [X.month_key("fecha").alias("Month"), F.col("country").alias("Country"), F.col("city").alias("City"),
            F.col("campaign").alias("Campaign")]
    names = ["Month", "Country", "City", "Campaign"]
    if source == "voucher":
        keys += [F.col("discount_type").alias("Discount_Type"), variation().alias("Variation")]
        names += ["Discount_Type", "Variation"]
        if exclude_like:
            acq = acq.filter(X.not_like_any("campaign", exclude_like))
        # the variation's parts stay in the row identity of an acquisition
        keys += [F.col("discount_amount").alias("_da"), F.col("discount_max_amount").alias("_dm"),
                 F.col("min_amount").alias("_mov")]
        hi = F.date_add("fecha", max_days)
        grain = "day_status"
    else:
        hi = F.lit(as_of)
        grain = "bucket"
    amounts = {"acq_amount": "Original_Amount_Used"}
    if variations:
        amounts["acq_amount_usd"] = "Original_Amount_Used_USD"
    acq = acq.select("user_id", "fecha", *amounts, *keys)
    return cohort_stats(acq, daily, names, names, metrics, hi, grain=grain, acq_amounts=amounts)


# ---------------------------------------------------------------- D6
FINAL_FROM = {  # fixed values: mature-cohort columns and their sources
    "M1": (["M1_Users_Final", "M1_Orders_Final", "Acq_M1"], ["M1_Users", "M1_Orders", "Acquisitions"]),
    "M2": (["M2_Users_Final", "M2_Orders_Final", "Acq_M2"], ["M2_Users", "M2_Orders", "Acquisitions"]),
    "M3": (["M3_Users_Final", "M3_Orders_Final", "Acq_M3"], ["M3_Users", "M3_Orders", "Acquisitions"]),
}
CLASS_FILTERS = ["BENEFICIOS", "TIPOS", "SEGMENTOS", "NIVELES", "CAMPAIGNS", "AUTOMATIONS", "BUDGET"]


def mature_mask(df: DataFrame) -> DataFrame:
    """RS2 / WN6: keep M2/M3 figures only for months old enough.

    Months are ranked newest first over the distinct months of the frame
    (a calendar-bounded list, broadcast back). With more than three months,
    M2 counts from the third newest month on; otherwise from the second. M3
    counts only for the oldest month.
    """
    months = df.select("Month").distinct()
    w = Window.orderBy(F.col("Month").desc())
    ranked = months.select("Month", F.dense_rank().over(w).alias("_r"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
    j = df.join(F.broadcast(ranked), "Month", "left")
    m2 = F.when(F.col("_n") > 3, F.col("_r") >= 3).otherwise(F.col("_r") >= 2)
    m3 = F.col("_r") == F.col("_n")
    cols = {}
    for b, cond in (("M1", F.lit(True)), ("M2", m2), ("M3", m3)):
        for dst, src in zip(*FINAL_FROM[b]):
            cols[dst] = F.when(cond, F.col(src)).otherwise(F.lit(0))
    return j.withColumns(cols).drop("_r", "_n")


def mature_cohorts(cohorts: DataFrame, index: list[str], rules: dict, filters=CLASS_FILTERS,
                   block=None) -> DataFrame:
    """Text keys cleaned, maturity mask, months summed away, campaign classes attached."""
    str_cols = list(dict.fromkeys(["Month", *index]))
    # the cohort table is read twice (month ranks and values): materialise it once
    # in the checkpoint folder instead of computing the cohort joins twice
    cohorts = cohorts.checkpoint(eager=True)
    df = cohorts.withColumns({c: F.coalesce(F.upper(F.col(c).cast("string")), F.lit("NONE")) for c in str_cols})
    df = df.withColumn("Campaign", F.regexp_replace("Campaign", " ", ""))
    df = mature_mask(df)
    values = [c for c in df.columns if c not in index and c != "Month"]
    pt = df.groupBy(*index).agg(*[F.sum(c).alias(c) for c in values])
    pt = R.classify_campaigns(pt, "Campaign", rules, filters)
    if block is not None:
        pt = R.drop_blocked(pt, "Campaign", block)
    return pt


# ---------------------------------------------------------------- D8
def adr_after_campaign(m, as_of: dt.date, like: str = "%CENTRAL%") -> DataFrame:
    """Per campaign, what its users spend on later orders (from the next day on) and the ADR ratios.

    A user with several campaign orders in one group contributes the same
    later orders once per campaign order (T31); the multiplicity is applied as
    a factor instead of materialising the pairs.
    """
    win3 = W.first_of_month(W.add_months(as_of, -3))
    win2 = W.first_of_month(W.add_months(as_of, -2))
    bt = voucher_uses(m, win3, as_of, win3, as_of, consumed_only=False)
    o = X.in_window(m.orders(), win2, as_of).filter(
                          (F.col("order_status") == "CONFIRMED"))
    dpo = _disc_per_order(m, win2, as_of)
    o = o.join(dpo, "order_id", "left").withColumns({
        "total_paid": F.col("shipping_amount_no_discount") + F.col("amount_no_discount"),
        "city": F.when(F.col("total_disc").isNull(), F.lit("-")).otherwise(F.coalesce("city_name", F.lit("-"))),
    })
    o = o.join(bt, "order_id", "left")
    acq_cols = ["country_name", "currency_id", "city", "campaign", "discount_type", "discount_amount",
                "discount_max_amount", "min_amount"]
    acq = (o.filter(F.col("campaign").isNotNull())
           .groupBy("user_id", F.col("registered_date").alias("fecha"), *acq_cols)
           .agg(F.count(F.lit(1)).alias("k")))
    later = o.groupBy("user_id", F.col("registered_date").alias("o_fecha")).agg(
        F.sum("total_paid").alias("p"), F.sum("total_disc").alias("d"),
        F.sum("total_voucher_disc").alias("v"), F.sum("amount_used").alias("u"),
        F.count_distinct("order_id").alias("n"))
    j = P.bucketed_range_join(acq, later, "user_id", F.date_add("fecha", 1), F.lit(as_of), "o_fecha")
    k = F.col("k")
    aft = j.groupBy("user_id", "fecha", *acq_cols).agg(
        F.sum(F.col("p") * k).alias("total_paid"), F.sum(F.col("d") * k).alias("total_disc"),
        F.sum(F.col("v") * k).alias("total_voucher_disc"), F.sum(F.col("u") * k).alias("amount_used"),
        F.sum("n").alias("orders"))
    aft = aft.filter(F.col("campaign").like(like))
    aft = with_fx(aft, m, "fecha")
    usd = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("rate_us")), F.lit(0.0))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    g = aft.groupBy(X.month_key("fecha").alias("Month"), F.col("country_name").alias("Country"),
                    F.col("city").alias("City"), F.col("campaign").alias("Campaign"),
                    F.col("discount_type").alias("Discount_Type"), F.col("discount_amount").alias("Amount"),
                    F.col("discount_max_amount").alias("Max_Amount"), F.col("min_amount").alias("MOV")).agg(
        F.count_distinct("user_id").alias("Users"),
        F.sum(z("total_paid")).alias("Total_Paid"), F.sum(z("total_disc")).alias("Total_Disc"),
        F.sum(z("total_voucher_disc")).alias("Total_Voucher_Disc"), F.sum(z("amount_used")).alias("Total_Amount_Used"),
        F.sum(usd("total_paid")).alias("Total_Paid_USD"), F.sum(usd("total_disc")).alias("Total_Disc_USD"),
        F.sum(usd("total_voucher_disc")).alias("Total_Voucher_Disc_USD"),
        F.sum(usd("amount_used")).alias("Total_Amount_Used_USD"),
        F.sum(z("orders")).cast("long").alias("Orders"))
    return g.withColumns({
        "ADR_Total_Disc": X.ratio_or_zero("Total_Disc", "Total_Paid"),
        "ADR_Voucher_Disc": X.ratio_or_zero("Total_Voucher_Disc", "Total_Paid"),
        "ADR_CRM_Used": X.ratio_or_zero("Total_Amount_Used", "Total_Paid"),
    })
