"""Lifecycle family: D9, D22-D30 (reorder, trials, returns, reactivation, no-return,
heavy users, frequency segments, ADR clusters).

All of these are user-level: they aggregate orders per (country, user) first,
then count users per group. Counting users as rows of a per-user aggregate
replaces COUNT(DISTINCT user) (no Expand), and the per-user aggregate shares
its shuffle on the user key with the joins that follow. A user's flags from
several sub-queries are computed as conditional aggregates over one scan
instead of self joins where the semantics allow.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import windows as W
from .history import NOT_QC, quick_before, state_before
from .primitives import one_row_per_order

def _conf(m, start=None, end=None) -> DataFrame:
    o = m.orders().filter(F.col("order_status") == "CONFIRMED")
    if start is not None and end is not None:
        return X.in_window(o, start, end)
    if end is not None:
        o = o.filter(F.col("registered_date") <= F.lit(end))
    return o


def _month_users(o: DataFrame) -> DataFrame:
    return o.select("user_id").distinct()


# ---------------------------------------------------------------- D22
def month_reorder(m, as_of: dt.date) -> DataFrame:
    """Last month's acquired vs active users and how many ordered again this month."""
    mw = W.month_windows(as_of)
    lm = _conf(m, mw.ilm, mw.flm).groupBy(F.col("country_name").alias("Country"), "user_id").agg(
        F.sum("is_acquisition").alias("acq"))
    tm = _month_users(_conf(m, mw.itm, mw.ftm)).withColumn("re", F.lit(True))
    j = lm.join(tm, "user_id", "left")
    acq, act, re = F.col("acq") > 0, F.col("acq") == 0, F.col("re").isNotNull()
    g = j.groupBy("Country").agg(
        F.count(F.when(acq, 1)).alias("Acq_LM"),
        F.count(F.when(act, 1)).alias("Active_LM"),
        F.count(F.when(acq & re, 1)).alias("Acq_Reorder"),
        F.count(F.when(act & re, 1)).alias("Active_Reorder"))
    return g.withColumns({
        "M1_Adq": X.ratio_or_zero("Acq_Reorder", "Acq_LM"),
        "No_Return": X.ratio_or_zero(F.col("Active_LM") - F.col("Active_Reorder"), "Active_LM"),
    })


# ---------------------------------------------------------------- D23
def vertical_trials(m, as_of: dt.date, start: dt.date, end: dt.date, excluded=NOT_QC) -> DataFrame:
    """Users of non-excluded verticals in [start, end] and how many try one for the first time."""
    qc = _conf(m, start, min(end, as_of - dt.timedelta(days=1))).filter(~F.col("business_type_name").isin(excluded))
    j = qc.join(quick_before(m, start, as_of, excluded), ["user_id", "country_name"], "left")
    new = (F.col("is_acquisition") == 0) & (F.coalesce(F.col("qc"), F.lit(0)) == 0)
    per_user = j.groupBy("country_name", "user_id").agg(F.max(F.when(new, 1).otherwise(0)).alias("trial"))
    g = per_user.groupBy(F.col("country_name").alias("Country")).agg(
        F.count(F.lit(1)).alias("Active_CQ"), F.sum("trial").cast("long").alias("Adq_QC"))
    return g.withColumn("%Trials", X.ratio_or_zero("Adq_QC", "Active_CQ"))


# ---------------------------------------------------------------- D25
def desired_returns(m, as_of: dt.date, adr_max: float = 0.3) -> DataFrame:
    """Lapsed low-discount users (6-month ADR < adr_max, last order <= end of month-2)
    and how many of them order this month."""
    start = W.first_of_month(W.add_months(as_of, -6))
    end = W.last_of_month(W.add_months(as_of, -1))
    lapsed = W.last_of_month(W.add_months(as_of, -2))
    disc = X.in_months(m.discounts(), start, end).groupBy("order_id").agg(
        F.sum(F.coalesce(F.col("discount_amount"), F.lit(0))).alias("total_disc"))
    paid = F.coalesce(F.col("shipping_amount_no_discount") + F.col("amount_no_discount"), F.lit(0))
    ot = _conf(m, start, end).join(disc, "order_id").withColumn("total_paid", paid)
    users = ot.groupBy("user_id", "country_name").agg(
        F.count(F.lit(1)).alias("orders"),
        F.try_divide(F.sum("total_disc").cast("double"), F.sum("total_paid").cast("double")).alias("adr"),
        F.max("registered_date").alias("last_order"))
    desired = users.filter((F.col("last_order") <= F.lit(lapsed)) & (F.col("adr") < adr_max))
    this_start, this_end = W.first_of_month(as_of), W.last_of_month(as_of)
    ret = (_conf(m, this_start, this_end).join(desired.select("user_id"), "user_id")
           .groupBy("country_name", "user_id").agg(F.count(F.lit(1)).alias("r_orders"))
           .withColumn("r_user", F.col("user_id")))
    j = desired.join(ret, ["user_id", "country_name"], "left")
    return j.groupBy(F.col("country_name").alias("Country")).agg(
        F.count(F.lit(1)).alias("Desired"),
        F.count("r_user").alias("Return_Desired"),
        F.sum("r_orders").alias("Return_Desired_Orders"))


# ---------------------------------------------------------------- D26
def reactivations(m, as_of: dt.date) -> DataFrame:
    """Users whose last order (up to last month) is on or before the end of month-2,
    and how many of them order this month (orders with at least one discount row)."""
    lapsed = W.last_of_month(W.add_months(as_of, -2))
    users = state_before(m, as_of).withColumnRenamed("last_lined", "last_order")
    react = users.filter(F.col("last_order") <= F.lit(lapsed)).select("user_id", "country_name")
    ret = (_conf(m, W.first_of_month(as_of), as_of).filter("has_lines")
           .join(react.select("user_id"), "user_id")
           .groupBy("country_name", "user_id").agg(F.count(F.lit(1)).alias("r_orders"))
           .withColumn("r_user", F.col("user_id")))
    j = react.join(ret, ["user_id", "country_name"], "left")
    return j.groupBy(F.col("country_name").alias("Country")).agg(
        F.count(F.lit(1)).alias("Reactivated"),
        F.count("r_user").alias("Return_Reactivated"),
        F.sum("r_orders").alias("Return_Reactivated_Orders"))


# ---------------------------------------------------------------- D27 / D28
def freq_type(x) -> F.Column:
    """SF27: order-count band; 0 -> 'Error'; a null count falls to the last band."""
    c = F.col(x) if isinstance(x, str) else x
    return (F.when(c == 0, "Error").when(c <= 2, "1-2").when(c <= 4, "3-4").when(c <= 10, "5-10")
            .otherwise("'+10"))


def adr_type(x, light: float = 0.2) -> F.Column:
    """'Light ADR' below the threshold; anything else, a null ratio too, is 'High ADR' (T3)."""
    c = F.col(x) if isinstance(x, str) else x
    return F.when(c < light, "Light ADR").otherwise("High ADR")


def _city_and_active_country(df: DataFrame, m) -> DataFrame:
    uc = m.user_cities().select(F.col("user_id").alias("_u"), F.col("country").alias("_uc"), F.col("city").alias("_ucity"))
    j = df.join(uc, (F.col("user_id") == F.col("_u")) & (F.col("country") == F.col("_uc")), "left")
    act = m.countries().filter(F.col("active")).select(F.col("country_name").alias("_cn"))
    return j.join(act, F.col("country") == F.col("_cn"), "inner")


def no_return(m, as_of: dt.date) -> DataFrame:
    """Last month's non-acquired active users by city, frequency band and ADR band, and how many
    did not order this month."""
    lm = W.add_months(as_of, -1)
    ut = _conf(m, W.first_of_month(lm), W.last_of_month(lm)).groupBy("user_id", F.col("country_name").alias("country")).agg(
        F.count(F.lit(1)).alias("freq"),
        F.sum(F.col("shipping_amount_no_discount") + F.col("amount_no_discount")).alias("total_amount"),
        F.sum("voucher_discount_amount").alias("voucher_d"),
        F.sum("is_acquisition").alias("acq"))
    tm = _month_users(_conf(m, W.first_of_month(as_of), W.last_of_month(as_of))).withColumn("back", F.lit(True))
    j = ut.join(tm, "user_id", "left")
    j = j.withColumn("adr", F.try_divide(F.col("voucher_d").cast("double"), F.col("total_amount").cast("double")))
    j = _city_and_active_country(j, m)
    na = F.col("acq") == 0
    # one row per (user, country): distinct users are counts
    return j.groupBy(F.col("country").alias("Country"), F.coalesce("_ucity", F.lit("-")).alias("City"),
                     freq_type("freq").alias("Freq_Type"), adr_type("adr").alias("ADR_Type")).agg(
        F.count(F.when(na, 1)).alias("Active_No_Acq_LM"),
        F.count(F.when(na & F.col("back").isNull(), 1)).alias("No_Returns"))


def reactivation_profile(m, as_of: dt.date) -> DataFrame:
    """Reactivated users who ordered this month, by city, frequency band of their last active
    month and 181-day ADR band; how many came back on an incentivised first order, and their orders.

    The reference's five sub-queries keyed by (user, country) become one join of the
    month's orders with the state of the users at the end of the month before.
    """
    lapsed = W.last_of_month(W.add_months(as_of, -2))
    t0 = W.first_of_month(as_of)
    inc = X.in_months(m.coupons(), t0, as_of).filter(F.col("order_id").isNotNull()).select("order_id").distinct().withColumn("incentive", F.lit(True))
    this = _conf(m, t0, as_of).join(inc, "order_id", "left")
    this = this.groupBy("user_id", "country_name").agg(
        F.count(F.lit(1)).alias("r_orders"),
        F.min(F.struct("order_id", F.coalesce("incentive", F.lit(False)).alias("incentive"))).alias("first_this"))
    state = state_before(m, as_of).filter(F.col("last_day") <= F.lit(lapsed)).select("user_id", "country_name", "tail.*")
    per_user = this.join(state, ["user_id", "country_name"]).withColumnRenamed("country_name", "country").withColumn(
        "adr", F.coalesce(F.try_divide(F.col("vouchers").cast("double"), F.col("paid").cast("double")), F.lit(0.0)))
    j2 = _city_and_active_country(per_user, m)
    return j2.groupBy(F.col("country").alias("Country"), F.coalesce("_ucity", F.lit("-")).alias("City"),
                      freq_type("freq").alias("Freq_Type"), adr_type("adr").alias("ADR_Type")).agg(
        F.count(F.lit(1)).alias("Return_Reactivated"),
        F.count(F.when(F.col("first_this.incentive"), 1)).alias("Return_Reactivated_Incentived"),
        F.coalesce(F.sum("r_orders"), F.lit(0)).cast("long").alias("Return_Reactivated_Orders"))


# ---------------------------------------------------------------- D24
def vertical_trials_by_campaign(m, as_of: dt.date, months: list[dt.date], countries=None,
                                excluded=NOT_QC) -> DataFrame:
    """Per country, business and campaign of the user's first non-excluded order of each month,
    the users trying such a vertical for the first time; one column ``Adq_QC-YYYY/MM`` per month."""
    from . import primitives as P
    o = m.orders().filter((F.col("order_status") == "CONFIRMED") & (F.col("registered_date") < F.lit(as_of)))
    qc_flag = ~F.col("business_type_name").isin(excluded)
    frames = []
    for month in months:
        m0, m1 = W.first_of_month(month), W.last_of_month(month)
        qc = X.in_window(o, m0, m1).filter(qc_flag)
        if countries is not None:
            qc = qc.filter(F.col("country_name").isin(countries))
        first = qc.groupBy("user_id", "country_name").agg(
            F.min(F.struct("order_id", "business_type_name", "is_acquisition")).alias("f"))
        j = first.join(quick_before(m, m0, as_of, excluded), ["user_id", "country_name"], "left").withColumn("order_id", F.col("f.order_id"))
        # the month's coupons meet the first orders only; an order with several campaigns counts for each
        inc = X.in_months(m.coupons(), m0, m1).filter(F.col("order_id").isNotNull()).select("order_id", "campaign_name").distinct()
        j = j.join(inc, "order_id", "left")
        new = (F.col("f.is_acquisition") == 0) & (F.coalesce(F.col("qc"), F.lit(0)) == 0)
        g = j.groupBy(F.col("country_name").alias("Country"), F.col("f.business_type_name").alias("Business"),
                      F.coalesce("campaign_name", F.lit("-")).alias("Campaign")).agg(
            F.count(F.when(new, 1)).alias(f"Adq_QC-{month:%Y/%m}"))
        g = g.withColumns({c: F.coalesce(F.upper(c), F.lit("NONE")) for c in ("Country", "Business", "Campaign")})
        g = g.withColumn("Campaign", F.regexp_replace("Campaign", " ", ""))
        frames.append(g)
    out = P.full_merge(frames, ["Country", "Business", "Campaign"])
    return out.fillna(0)


# ---------------------------------------------------------------- D29
def heavy_users_repeat(m, as_of: dt.date, threshold: int = 7, months: int = 13) -> DataFrame:
    """Per country and month: active users, orders, users and orders at or above ``threshold``
    this and last month, users repeating it, and frequency ratios; first month dropped (FLT8)."""
    from . import primitives as P
    start = W.n_month_start(as_of, months)
    end = W.last_of_month(as_of) if as_of.day != 1 else as_of - dt.timedelta(days=1)
    o = _conf(m, start, end)
    per = o.groupBy("user_id", "country_id", F.trunc("registered_date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"))
    ft = P.with_previous_period(per, ["user_id", "country_id"], "month", "orders",
                                lambda c: F.add_months(c, 1), W.first_of_month(end))
    seq = F.sequence(F.lit(W.first_of_month(start)), F.lit(W.first_of_month(end)), F.expr("interval 1 month"))
    return heavy_repeat_stats(ft, m, threshold, seq, "yyyy-MM", start.strftime("%Y-%m"))


def heavy_repeat_stats(ft: DataFrame, m, threshold: int, periods, fmt: str, first_label: str) -> DataFrame:
    """Statistics per (country, period) over the whole period grid of every active country.

    The grid (countries x periods of the window) comes from exploding the
    period sequence on the distinct countries, so empty periods still show
    up with zeros, as in the reference's densified grid.
    """
    tm, lm = F.col("orders"), F.col("orders_lm")
    hi_t, hi_l = tm >= threshold, lm >= threshold
    z = F.lit(0)
    stats = ft.groupBy("country_id", "month").agg(
        F.count(F.when(tm > 0, 1)).alias("Active_Users"),
        F.sum(tm).cast("long").alias("Confirmed_Orders"),
        F.count(F.when(hi_t, 1)).alias("Users_Over7_TM"),
        F.count(F.when(hi_l, 1)).alias("Users_Over7_LM"),
        F.sum(F.when(hi_t, tm).otherwise(z)).cast("long").alias("Orders_Over7_TM"),
        F.sum(F.when(hi_l, lm).otherwise(z)).cast("long").alias("Orders_Over7_LM"),
        F.count(F.when(hi_t & hi_l, 1)).alias("Repeated_Users_Over7"),
        F.sum(F.when(hi_t & hi_l, tm).otherwise(z)).cast("long").alias("Repeated_Orders_Over7_TM"),
        F.sum(F.when(hi_t & hi_l, lm).otherwise(z)).cast("long").alias("Repeated_Orders_Over7_LM"))
    # the per-(country, period) statistics are small; materialise them once and
    # take the grid's countries from them instead of re-reading the user facts
    stats = stats.checkpoint(eager=True)
    grid = stats.select("country_id").distinct().withColumn("month", F.explode(periods))
    g = grid.join(stats, ["country_id", "month"], "left").fillna(0)
    cn = m.countries().select("country_id", F.col("country_name").alias("Country"))
    g = g.join(cn, "country_id", "left")
    g = g.groupBy("Country", F.date_format("month", fmt).alias("Month")).agg(
        *[F.sum(c).cast("long").alias(c) for c in stats.columns if c not in ("country_id", "month")])
    g = g.withColumns({
        "Freq": X.ratio_or_zero("Confirmed_Orders", "Active_Users"),
        "Freq7_TM": X.ratio_or_zero("Orders_Over7_TM", "Users_Over7_TM"),
        "Freq7_LM": X.ratio_or_zero("Orders_Over7_LM", "Users_Over7_LM"),
        "Repeating_Users7": X.ratio_or_zero("Repeated_Users_Over7", "Users_Over7_LM"),
        "Freq_Repeating_TM": X.ratio_or_zero("Orders_Over7_TM", "Repeated_Users_Over7"),
        "Freq_Repeating_LM": X.ratio_or_zero("Orders_Over7_LM", "Repeated_Users_Over7"),
    })
    # the first period of the window has no previous period to compare (FLT8)
    return g.filter(F.col("Month") != F.lit(first_label))


def heavy_users_repeat_events(events: DataFrame, m, start: dt.date, end: dt.date, threshold: int = 7) -> DataFrame:
    """D29 on the event stream: user x week activity (all events in [start, end]) with the same
    statistics; weeks start on Monday and are labelled by that Monday; country unknown ('-')."""
    from . import primitives as P
    ev = events.filter(F.to_date("ts").between(F.lit(start), F.lit(end)))
    per = ev.groupBy("user_id", F.date_trunc("week", "ts").cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("orders")).withColumn("country_id", F.lit(-1))
    first_week = start - dt.timedelta(days=start.weekday())
    last_week = end - dt.timedelta(days=end.weekday())
    ft = P.with_previous_period(per, ["user_id", "country_id"], "month", "orders", lambda c: F.date_add(c, 7), last_week)
    seq = F.sequence(F.lit(first_week), F.lit(last_week), F.expr("interval 7 days"))
    out = heavy_repeat_stats(ft, m, threshold, seq, "yyyy-MM-dd", first_week.isoformat())
    return out.withColumn("Country", F.coalesce("Country", F.lit("-")))


# ---------------------------------------------------------------- D30
def frequency_bands(m, start: dt.date, end: dt.date, country: str | None = None) -> DataFrame:
    """Users per month by order-count band (1-3, 4-6, +7), their orders, frequency, and each
    band's share of the month's users and orders (WN4)."""
    from . import primitives as P
    o = _conf(m, start, end)
    if country is not None:
        o = o.filter(F.col("country_name") == country)
    ut = o.groupBy(X.month_key("registered_date").alias("Month"), "user_id").agg(F.count(F.lit(1)).alias("orders"))
    n = F.col("orders")
    tipo = F.when((n >= 1) & (n <= 3), "1-3").when((n >= 4) & (n <= 6), "4-6").when(n >= 7, "+7").otherwise("-")
    g = ut.groupBy("Month", tipo.alias("Tipo")).agg(F.count(F.lit(1)).alias("Users"),
                                                    F.sum("orders").cast("long").alias("Orders"))
    return g.withColumns({
        "Freq": X.safe_ratio("Orders", "Users"),
        "%Orders": P.share_of_group("Orders", ["Month"]),
        "%Users": P.share_of_group("Users", ["Month"]),
    })


# ---------------------------------------------------------------- D9
ADR_EDGES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]  # fixed values


def adr_cluster(x) -> F.Column:
    """'Under 10' ... 'Under 90', 'Over 90' by the discount ratio."""
    c = F.col(x) if isinstance(x, str) else x
    expr = None
    for e in ADR_EDGES:
        lab = f"Under {int(round(e * 100))}"
        expr = F.when(c < e, lab) if expr is None else expr.when(c < e, lab)
    return expr.otherwise("Over 90")


def adr_user_clusters(m, as_of: dt.date, new_since: dt.date, orders_from: dt.date, orders_to: dt.date,
                      window_days: int = 181, countries=None) -> DataFrame:
    """Users by 181-day discount ratio decile and new/old, with cluster size, and their orders,
    voucher orders, GMV and coupon spend per city, area, campaign and month (raw form)."""
    new = (X.since(m.orders(), new_since).filter(F.col("is_acquisition") == 1)
           .select("user_id").distinct().withColumn("new_user", F.lit(True)))
    act = m.countries().filter(F.col("active")).select("country_id")
    o = (X.since(m.orders(), as_of - dt.timedelta(days=window_days)).filter(F.col("order_status") == "CONFIRMED")
         .join(act, "country_id"))
    ut = o.groupBy("user_id", F.col("country_name").alias("country")).agg(
        F.sum(F.col("shipping_amount_no_discount") + F.col("amount_no_discount")).alias("ta"),
        F.sum("voucher_discount_amount").alias("vd"))
    ut = ut.join(new, "user_id", "left").withColumn("new_user", F.coalesce("new_user", F.lit(False)))
    ut = ut.withColumn("adr", F.coalesce(F.try_divide(F.col("vd").cast("double"), F.col("ta").cast("double")), F.lit(0.0)))
    ut = ut.withColumn("adr_cluster", adr_cluster("adr"))
    if countries is not None:
        ut = ut.filter(F.col("country").isin(countries))
    # cluster sizes: a partial aggregate (a cluster key may hold a third of the
    # users, so no window over it); at most countries x 2 x 10 rows, broadcast back
    cl = ut.groupBy("country", "new_user", "adr_cluster").agg(F.count(F.lit(1)).alias("cluster_users"))
    ut = ut.join(F.broadcast(cl), ["country", "new_user", "adr_cluster"], "left")
    coup = X.in_months(m.coupons(), orders_from, orders_to).select("order_id", "campaign_name", F.col("used_amount").alias("used"))
    ot = (X.in_window(m.orders(), orders_from, orders_to).filter(F.col("order_status") == "CONFIRMED")
          .join(coup, "order_id", "left")
          .select("user_id", F.col("country_name").alias("country"), "order_id", "registered_date",
                  F.coalesce("city_name", F.lit("-")).alias("city"), F.coalesce("area_name", F.lit("-")).alias("area"),
                  F.col("campaign_name"), F.col("used").isNotNull().alias("with_voucher"), "used",
                  (F.col("total_amount") + F.col("shipping_amount")).alias("gmv"),
                  F.coalesce(F.col("payment_mode") != "TOTAL_AMOUNT", F.lit(False)).alias("shopper")))
    j = ut.join(ot, ["user_id", "country"], "left")
    keys = [F.col("country").alias("Country"), F.col("adr_cluster").alias("ADR_Cluster"),
            F.when(F.col("new_user"), "New").otherwise("Old").alias("User_Type"),
            F.col("cluster_users").alias("Cluster_Users"), F.col("city").alias("City"),
            F.col("area").alias("Area"), F.coalesce("campaign_name", F.lit("-")).alias("Campaign"),
            X.month_key("registered_date").alias("Month")]
    sums = {"GMV": F.col("gmv"), "Amount": F.when(F.col("shopper") == F.lit(False), F.col("used")).otherwise(F.lit(0)),
            "Amount_Shopper": F.when(F.col("shopper"), F.col("used")).otherwise(F.lit(0))}
    j = one_row_per_order(j, keys, ["with_voucher"], sums)  # users without orders share a row without order_id
    return j.groupBy("Country", "ADR_Cluster", "User_Type", "Cluster_Users", "City", "Area", "Campaign", "Month").agg(
        F.count("order_id").alias("Total_Orders"), F.count(F.when(F.col("with_voucher"), 1)).alias("Voucher_Orders"),
        F.sum("GMV").alias("GMV"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("Amount", "Amount_Shopper")])


NO_BUDGET = ["DMARTS", "NONE", "-"]  # fixed values


def adr_cluster_board(raw: DataFrame, rules: dict, tax: DataFrame, zones: DataFrame, block) -> DataFrame:
    """D9 board: classes ('-' without campaign, RS8), tax, block flag, budget groups (RS9),
    competition zone, then the pivot with the cluster size averaged (T32)."""
    from . import spend as S
    from ..functions import rules as R
    df = raw.withColumns({c: F.coalesce(F.upper(F.col(c).cast("string")), F.lit("NONE"))
                          for c in ["Country", "ADR_Cluster", "City", "Area", "User_Type", "Campaign", "Month"]})
    df = df.withColumn("Campaign", F.regexp_replace("Campaign", " ", ""))
    none = F.col("Campaign") == "-"
    for f in ["TIPOS", "SEGMENTOS", "NIVELES", "CAMPAIGNS", "AUTOMATIONS", "BUDGET", "TRIAL"]:
        df = df.withColumn(R.FILTER_COLUMNS[f], F.when(none, F.lit("-")).otherwise(R.classify("Campaign", f, rules)))
    df = R.net_of_tax(df, tax, "Amount_Shopper", "Amount")
    df = df.withColumn("Filtrar", R.blocked("Campaign", block))
    df = df.withColumn("Tipo", F.when(F.col("Type") == "VOUCHER CAMPAIGNS", "-").otherwise("OK"))
    df = df.withColumn("Budget", F.when(F.col("Budget").isin(NO_BUDGET), "-").otherwise(F.col("Budget")))
    df = S.attach_competition(df, zones)
    index = ["Country", "Month", "ADR_Cluster", "User_Type", "Competencia", "Budget", "Filtrar", "Tipo"]
    return df.groupBy(*index).agg(
        F.avg("Cluster_Users").alias("Cluster_Users"), F.sum("Total_Orders").alias("Total_Orders"),
        F.sum("Voucher_Orders").alias("Voucher_Orders"), F.coalesce(F.sum("GMV"), F.lit(0)).alias("GMV"),
        F.sum("Final").alias("Final"))
