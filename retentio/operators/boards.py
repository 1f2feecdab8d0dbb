"""Boards and scorecards: D19, D20, D21, D33, D34, D39, D40, D42, D44 (and helpers).

Every function takes the logical model (``retentio.sources.adapter.Model``) and
explicit dates, and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import windows as W


def confirmed_orders(m, start: dt.date, end: dt.date) -> DataFrame:
    """SRC6 + FLT1/FLT2: confirmed orders registered in [start, end]."""
    o = m.orders()
    return X.in_window(o, start, end).filter(
                    (F.col("order_status") == "CONFIRMED"))


def monthly_kpis(m, start: dt.date, end: dt.date, by_month: bool = False) -> DataFrame:
    """Orders, acquisitions and active users per country (and month) in a window.

    ``order_id`` is the key of the order fact, so COUNT(DISTINCT order_id) is a
    plain count and the acquisition count a sum of the 0/1 flag. Only the user
    count needs a distinct aggregate, so the plan has no Expand.
    """
    o = confirmed_orders(m, start, end)
    keys = [F.col("country_name").alias("Country")]
    if by_month:
        keys.append(X.month_key("registered_date").alias("Month"))
    return o.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("Orders"),
        F.sum("is_acquisition").cast("long").alias("Acq"),
        F.count_distinct("user_id").alias("Active_Users"),
    )


# ---------------------------------------------------------------- D20
def run_rate_frame(spark, as_of: dt.date, fri=1.4, sat=1.4, sun=1.4) -> DataFrame:
    """D20 as a one-row frame: weighted share of the month elapsed before ``as_of``.

    The month's days come from ``sequence`` + ``explode``; weights are exact
    tenths so both sums are integers and the ratio is rounded once.
    """
    first = W.first_of_month(as_of)
    last = W.last_of_month(as_of)
    tenth = [int(round(w * 10)) for w in (fri, sat, sun)]
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("d"))
    wd = F.weekday("d")
    w = (F.when(wd == 4, tenth[0]).when(wd == 5, tenth[1]).when(wd == 6, tenth[2]).otherwise(10))
    g = days.agg(F.sum(w).alias("total"), F.sum(F.when(F.col("d") < F.lit(as_of), w).otherwise(0)).alias("done"))
    rr = F.when(F.lit(as_of.day == 1), F.lit(1.0)).when(F.col("done") == 0, F.lit(0.01)).otherwise(
        F.col("done").cast("double") / F.col("total"))
    return g.select(rr.alias("rr"))


def project(df: DataFrame, cols, rr: float, suffix=" RR") -> DataFrame:
    """Run-rate projection ``bround(x / rr)`` (pandas/Python rounding: half to even, T13)."""
    return df.withColumns({f"{c}{suffix}": F.bround(F.col(c) / F.lit(rr), 0) for c in cols})


# ---------------------------------------------------------------- D44
def country_scorecard(m, as_of: dt.date) -> DataFrame:
    """D21 + D22 + D23 + D25 + D26 outer-joined on Country, gaps as 0, ratios and projections."""
    from . import lifecycle as L
    mw = W.month_windows(as_of)
    rr = W.run_rate(as_of)
    parts = [
        monthly_kpis(m, mw.itm, mw.ftm),
        L.month_reorder(m, as_of).drop("M1_Adq", "No_Return"),
        L.vertical_trials(m, as_of, mw.itm, mw.ftm).drop("%Trials"),
        L.desired_returns(m, as_of),
        L.reactivations(m, as_of),
    ]
    parts = [p.withColumn("Country", F.coalesce(F.upper("Country"), F.lit("NONE"))) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "Country", "full")
    nums = [c for c in out.columns if c != "Country"]
    out = out.fillna(0, subset=nums)
    out = out.withColumns({
        "M1_Adq": X.ratio_or_zero("Acq_Reorder", "Acq_LM"),
        "No_Return": X.ratio_or_zero(F.col("Active_LM") - F.col("Active_Reorder"), "Active_LM"),
        "%Trials": X.ratio_or_zero("Adq_QC", "Active_CQ"),
        "%Return Desired": X.ratio_or_zero("Return_Desired", "Desired"),
    })
    out = project(out, ["Orders", "Acq", "Adq_QC"], rr)
    out = out.withColumns({
        "Reactivated RR": F.bround(F.col("Return_Reactivated") / F.lit(rr), 0),
        "Return_Desired RR": F.bround(F.col("Return_Desired") / F.lit(rr), 0),
        "RR": F.lit(rr),
    })
    return out


# ---------------------------------------------------------------- D33 / D34 / D35
def _eur(x):
    return F.try_divide(F.col(x).cast("double") if isinstance(x, str) else x.cast("double"), F.col("rate_eu"))


FAILED = ["REJECTED", "PENDING", "CANCELLED"]  # fixed values


def order_funnel(m, start: dt.date, end: dt.date) -> DataFrame:
    """Per country, month and business: orders, failures by owner, users, free delivery, jokers,
    vouchers, revenue and gross values in EUR. One row per order, so distinct orders are counts."""
    from .spend import with_fx
    o = with_fx(X.in_window(m.orders(), start, end), m)
    conf = F.col("order_status") == "CONFIRMED"
    log = F.col("with_logistics")
    fail = F.col("order_status").isin(FAILED)
    free = F.col("shipping_amount_no_discount") == 0
    n = lambda cond: F.count(F.when(cond, 1))
    gfv = F.col("total_amount") + F.col("discount_paid_by_company") + F.col("shipping_amount") - F.col("shipping_amount_no_discount")
    gmv = F.col("total_amount") + F.col("shipping_amount") + F.col("discount_paid_by_company")
    z = F.lit(0.0)
    keys = ["Country", "Month", "Business"]
    # a row per user first: users are counted as rows, without the Expand of two distinct counts
    per_user = o.groupBy(F.col("country_name").alias("Country"), X.month_key("registered_date").alias("Month"),
                         F.col("business_type_name").alias("Business"), "user_id").agg(
        F.count(F.lit(1)).alias("Total"),
        n(conf).alias("Confirmed"),
        n(conf & log).alias("Logistic"),
        n(fail).alias("FR_Num"),
        n(fail & (F.col("fail_rate_owner") == "Platform")).alias("PFR_Num"),
        n(fail & (F.col("fail_rate_owner") == "Restaurant")).alias("VFR_Num"),
        n(fail & (F.col("fail_rate_owner") == "User")).alias("UFR_Num"),
        n(fail & (F.col("fail_rate_owner") == "Rider")).alias("RFR_Num"),
        n(free & conf).alias("DF_Free"),
        n(free & log & conf).alias("DF_Free_Log"),
        F.sum(F.when(conf, _eur("commission_amount"))).alias("Confirmed_Revenue"),
        F.sum(F.when(log & conf, _eur("commission_amount")).otherwise(z)).alias("Confirmed_Revenue_Log"),
        n((F.col("has_voucher_discount") > 0) & conf).alias("Confirmed_Vouchers"),
        n((F.col("has_joker_discount") > 0) & conf).alias("Confirmed_Jokers"),
        n((F.col("has_joker_discount") > 0) & log & conf).alias("Confirmed_Jokers_Log"),
        F.sum(F.when(log & conf, _eur(gfv)).otherwise(z)).alias("GFV_Gross_Log"),
        F.sum(F.when((log == F.lit(False)) & conf, _eur(gmv)).otherwise(z)).alias("GMV_Gross_Mktp"),
        F.sum(F.when(conf, _eur(gfv)).otherwise(z)).alias("GFV_Gross_Total"),
        F.sum(F.when(conf, _eur("shipping_amount_no_discount")).otherwise(z)).alias("DF_No_Discount_Total"),
        F.sum(F.when(log & conf, _eur("shipping_amount_no_discount")).otherwise(z)).alias("DF_No_Discount_Log"),
        F.sum(F.when(conf, _eur("discount_paid_by_company")).otherwise(z)).alias("Discounts_Company_Total"),
    )
    sums = [c for c in per_user.columns if c not in (*keys, "user_id")]
    return per_user.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], F.count("user_id").alias("Total_Users"),
        F.count(F.when((F.col("Confirmed") > 0) & F.col("user_id").isNotNull(), 1)).alias("Active_Users"))


def partner_status(m, start: dt.date, end: dt.date) -> DataFrame:
    """Online, churned and zombie (online without confirmed orders) partners per country, month, business."""
    pm = m.partners_monthly().filter(F.to_date("full_date").between(F.lit(start), F.lit(end)))
    p = m.partners().select(F.col("partner_id").alias("restaurant_id"), "country_id", "business_type_name")
    cn = m.countries().select("country_id", "country_name")
    j = pm.join(p, "restaurant_id", "left").join(cn, "country_id", "left").filter(F.col("country_name").isNotNull())
    # one row per (partner, month): distinct partners are counts
    return j.groupBy(F.col("country_name").alias("Country"), F.date_format("full_date", "yyyy-MM").alias("Month"),
                     F.col("business_type_name").alias("Business")).agg(
        F.count(F.when(F.col("is_online"), 1)).alias("Online"),
        F.count(F.when(F.col("is_churned"), 1)).alias("Churns"),
        F.count(F.when(F.col("is_online") & ~F.col("has_confirmed_orders"), 1)).alias("Zombies"))


FOOD = ["Restaurant", "Coffee"]  # fixed values


def business_board(funnel: DataFrame, partners: DataFrame) -> DataFrame:
    """D33 + D34 outer-merged on (Country, Business, Month), gaps 0, all-zero rows dropped (FLT7),
    Food/NV and Restaurant/NV labels (RS7)."""
    keys = ["Country", "Business", "Month"]
    j = funnel.join(partners, keys, "full")
    metrics = [c for c in j.columns if c not in keys]
    j = j.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in metrics})
    j = j.filter(X.any_nonzero(metrics))
    return j.withColumns({
        "Food/NV": F.when(F.col("Business").isin(FOOD), "Food").otherwise("NV"),
        "Restaurant/NV": F.when(F.col("Business") == "Restaurant", "Restaurant").otherwise("NV"),
    })


def discount_mix(m, start: dt.date, end: dt.date, by=("Country",)) -> DataFrame:
    """Confirmed orders and discount spend (EUR) by discount type x payer x month (and ``by``)."""
    from .spend import with_fx
    o = X.in_window(m.orders(), start, end).filter(F.col("order_status") == "CONFIRMED")
    j = with_fx(o.join(X.in_months(m.discounts(), start, end), "order_id"), m)
    keys = {"Country": F.col("country_name"), "City": F.col("city_name"), "Area": F.col("area_name")}
    g = j.groupBy(*[keys[b].alias(b) for b in by], X.month_key("registered_date").alias("Month"),
                  F.coalesce("discount_type_name", F.lit("-")).alias("Discount_Type"),
                  F.coalesce("discount_paid_by", F.lit("-")).alias("Paid_By")).agg(
        F.count_distinct("order_id").alias("Confirmed"),
        X.money(F.coalesce(F.sum(_eur("discount_amount")), F.lit(0.0))).alias("Amount"))
    return g


def discount_mix_pivot(mix: DataFrame, types=("FREE_DELIVERY", "JOKER", "VOUCHER"), payer: str = "COMPANY") -> DataFrame:
    """D35 pivot: company-paid amount per month and discount type, total and voucher share (%)."""
    p = (mix.filter(F.col("Paid_By") == payer).groupBy("Month").pivot("Discount_Type", list(types))
         .agg(F.sum("Amount")))
    p = p.select("Month", *[F.coalesce(F.col(t), F.lit(0.0)).alias(t) for t in types])
    total = sum((F.col(t) for t in types[1:]), F.col(types[0]))
    p = p.withColumn("Total", total)
    return p.withColumn("%Voucher", F.bround(F.try_divide(F.col("VOUCHER"), F.col("Total")) * 100, 2))


# ---------------------------------------------------------------- D39 / D40
def user_city_based(m) -> DataFrame:
    """Users by assignment basis, in millions and as a share (%) of all users."""
    uc = m.user_cities()
    b = uc.groupBy(F.col("based").alias("Based")).agg(F.count_distinct("user_id").alias("Users"))
    tot = F.sum("Users").over(Window.partitionBy())  # a handful of rows (one per basis)
    return b.withColumns({
        "Users MM": F.col("Users") / F.lit(1000000.0),
        "Total MM": tot / F.lit(1000000.0),
        "%": F.bround(F.col("Users") / tot * 100, 2),
    })


def user_city_distribution(m) -> DataFrame:
    """Users per country and city, share of the country and cumulative share in descending
    user order (Pareto, WN3); ties broken by city name (T8)."""
    from . import primitives as P
    uc = m.user_cities()
    per = uc.groupBy(F.col("country").alias("Country"), F.col("city").alias("City"), F.col("based").alias("Based")).agg(
        F.count_distinct("user_id").alias("Users"))
    c = per.groupBy("Country", "City").agg(F.sum("Users").alias("Users"))
    tot = F.sum("Users").over(Window.partitionBy("Country"))
    c = c.withColumns({
        "Users MM": F.col("Users") / F.lit(1000000.0),
        "Total MM": tot / F.lit(1000000.0),
        "%": F.bround(F.col("Users") / tot * 100, 2),
    })
    return c.withColumn("Acum", P.running_sum("%", ["Country"], [F.col("Users").desc(), F.col("City").asc()]))


def voucher_order_audit(m, start: dt.date, end: dt.date) -> DataFrame:
    """Voucher trades of any type joined to the window's orders; row count per country and order status."""
    o = X.in_window(m.orders(), start, end).select(
        F.col("order_id").alias("id"), F.col("order_status").alias("status"), F.col("country_name").alias("country"))
    t = X.in_months(m.trades(), start, end).select("coupon_id", "code", "order_id")
    j = t.join(o, t.order_id == o.id, "inner")
    rows = j.select(F.col("coupon_id").alias("Id"), F.col("code").alias("Code"),
                    F.coalesce(F.col("id").cast("string"), F.lit("-")).alias("Order_Id"),
                    F.coalesce(F.col("status").cast("string"), F.lit("-")).alias("Order_Status"),
                    F.coalesce("country", F.lit("-")).alias("Country"))
    return rows.groupBy("Country", "Order_Status").agg(F.count(F.lit(1)).alias("Rows"))


# ---------------------------------------------------------------- D19
def week_type(fecha, inicio: dt.date, fin: dt.date) -> F.Column:
    """RS4: last complete week / current week / week before."""
    d = F.col(fecha) if isinstance(fecha, str) else fecha
    return (F.when(d.between(F.lit(inicio), F.lit(fin)), "Last Complete Week")
            .when(d > F.lit(fin), "Current Week").otherwise("Week Before"))


def weekly_orders_board(m, as_of: dt.date) -> DataFrame:
    """D19 orders: daily orders, acquisitions and active users summed to country, month, ISO week and
    week type (daily active users summed over days, T17); week finished flag."""
    inicio, fin = W.last_complete_week(as_of)
    start = fin - dt.timedelta(days=41)
    end = W.last_of_month(as_of) if as_of.day != 1 else as_of - dt.timedelta(days=1)
    o = X.in_window(m.orders(), start, end).filter(F.col("order_status") == "CONFIRMED")
    daily = o.groupBy(F.col("country_name").alias("Country"), F.col("registered_date").alias("Fecha")).agg(
        F.count(F.lit(1)).alias("Orders"), F.sum("is_acquisition").cast("long").alias("Acq"),
        F.count_distinct("user_id").alias("Active_Users"))
    daily = daily.withColumns({
        "Country": F.coalesce(F.upper("Country"), F.lit("NONE")),
        "Month": X.month_key("Fecha"),
        "Week": F.lpad(X.iso_week("Fecha").cast("string"), 2, "0"),
        "Week Type": week_type("Fecha", inicio, fin),
    })
    pt = daily.groupBy("Country", "Month", "Week", "Week Type").agg(
        F.sum("Orders").alias("Orders"), F.sum("Acq").alias("Acq"), F.sum("Active_Users").alias("Active_Users"))
    return pt.withColumn("Week Finished", F.when(F.col("Week Type") != "Current Week", "Si").otherwise("No"))


def weekly_spend_board(m, as_of: dt.date, rules: dict, tax: DataFrame, block) -> DataFrame:
    """D19 spend: coupon and wallet spend per month, ISO week, week type, country, payer, type and
    budget; the shopper-paid part netted of tax."""
    from . import spend as S
    from ..functions import rules as R
    inicio, fin = W.last_complete_week(as_of)
    start = fin - dt.timedelta(days=41)
    end = W.last_of_month(as_of) if as_of.day != 1 else as_of - dt.timedelta(days=1)
    def prep(df):
        df = S.clean_campaign_frame(df, ["Fecha", "Country", "Campaign", "Payment_Shopper"])
        d = F.to_date("Fecha")
        return df.withColumns({"Month": X.month_key(d), "Week": F.lpad(X.iso_week(d).cast("string"), 2, "0"),
                               "Week Type": week_type(d, inicio, fin)})
    crudo = prep(S.coupon_spend_daily(m, start, end, W.add_months(start, -12)))
    crudo = crudo.withColumns({"Budget": R.classify("Campaign", "BUDGET", rules),
                               "Type": R.classify("Campaign", "TIPOS", rules)})
    crudo = R.drop_blocked(crudo, "Campaign", block)
    wallet = prep(S.wallet_spend(m, start, end))
    wallet = wallet.withColumns({"Budget": R.classify("Campaign", "BUDGET", rules), "Type": F.lit("WALLET")})
    wallet = R.drop_blocked(wallet, "Campaign", block)
    index = ["Month", "Week", "Week Type", "Country", "Payment_Shopper", "Type", "Budget"]
    values = ["Redeemed", "Redeemed_Confirmed", "Acq", "Used_Amount", "Used_Amount_USD", "Used_Amount_Confirmed",
              "Used_Amount_Confirmed_USD"]
    def typed(df):  # counts as long, local money as exact decimal, USD as double
        return df.select(*index, *[F.col(v).cast("long" if v in values[:3] else
                                                 "double" if v.endswith("USD") else "decimal(28,4)").alias(v)
                                   for v in values])
    both = typed(crudo).unionByName(typed(wallet))
    pt = both.groupBy(*index).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values])
    pt = R.attach_tax(pt, tax)
    net = lambda c: F.col(c) / (F.lit(1.0) + F.col("IVA")) * F.col("Extra")
    pt = pt.withColumns({
        "Used_Final": F.when(F.col("Payment_Shopper") == "NO", net("Used_Amount_Confirmed"))
                       .when(F.col("Payment_Shopper") == "SI", F.col("Used_Amount_Confirmed")),
        "Used_USD_Final": F.when(F.col("Payment_Shopper") == "NO", net("Used_Amount_Confirmed_USD"))
                           .when(F.col("Payment_Shopper") == "SI", F.col("Used_Amount_Confirmed_USD")),
    })
    return pt.withColumn("Week Finished", F.when(F.col("Week Type") != "Current Week", "Si").otherwise("No"))


def crm_scorecard(crm: DataFrame, as_of: dt.date, rules: dict, tax: DataFrame, block) -> DataFrame:
    """D44 (CRM part): this month's CRM spend by country, type (wallet forced), budget and trial,
    net of tax, with run-rate projections (half-to-even rounding, T13)."""
    from .spend import clean_campaign_frame
    from ..functions import rules as R
    rr = W.run_rate(as_of)
    df = clean_campaign_frame(crm, ["Country", "Campaign", "Benefit"])
    df = df.withColumns({
        "Type": R.classify("Campaign", "TIPOS", rules, benefit="Benefit"),
        "Segment": R.classify("Campaign", "SEGMENTOS", rules), "Level": R.classify("Campaign", "NIVELES", rules),
        "Campaña": R.classify("Campaign", "CAMPAIGNS", rules), "Automated": R.classify("Campaign", "AUTOMATIONS", rules),
        "Budget": R.classify("Campaign", "BUDGET", rules), "Trial": R.classify("Campaign", "TRIAL", rules)})
    df = R.net_of_tax(df, tax, "Amount_Shopper", "Amount")
    df = R.drop_blocked(df, "Campaign", block)
    pt = df.groupBy("Country", "Type", "Budget", "Trial").agg(
        F.coalesce(F.sum("Orders_CRM"), F.lit(0)).alias("Orders_CRM"),
        F.coalesce(F.sum("Acq_CRM"), F.lit(0)).alias("Acq_CRM"),
        F.coalesce(F.sum("Final"), F.lit(0.0)).alias("Final"))
    pt = project(pt, ["Orders_CRM", "Acq_CRM", "Final"], rr)
    return pt.withColumn("RR", F.lit(rr))


def filtered_totals(df: DataFrame, condition, cols) -> DataFrame:
    """AG16: whole-frame totals of some columns under a filter (one row)."""
    return df.filter(condition).agg(*[F.sum(c).alias(c) for c in cols])


def discount_mix_competition(m, since: dt.date, competition: DataFrame, big_city: str, countries=None) -> DataFrame:
    """D35 (zone form): confirmed orders and discount spend (USD) by city, area and competition
    level; the big city is split into its areas (City_Final); rows without a discount type
    are dropped."""
    from .spend import with_fx
    o = m.orders().filter((F.col("registered_date") >= F.lit(since)) & (F.col("order_status") == "CONFIRMED"))
    if "order_month" in o.columns:
        o = o.filter(F.col("order_month") >= F.trunc(F.lit(since), "MM"))
    if countries is not None:
        o = o.filter(F.col("country_name").isin(countries))
    d = X.in_months(m.discounts(), since).filter(F.col("discount_type_name").isNotNull())
    j = with_fx(o.join(d, "order_id"), m)
    city = F.coalesce("city_name", F.lit("-"))
    area = F.coalesce("area_name", F.lit("-"))
    final = F.when(F.col("city_name") == big_city, area).otherwise(city)
    usd = F.try_divide(F.col("discount_amount").cast("double"), F.col("rate_us"))
    g = j.groupBy(F.col("country_name").alias("Country"), city.alias("City"), area.alias("Area"),
                  final.alias("City_Final"), X.month_key("registered_date").alias("Month"),
                  F.col("discount_type_name").alias("Discount_Type"),
                  F.coalesce("discount_paid_by", F.lit("-")).alias("Paid_By")).agg(
        F.count_distinct("order_id").alias("Confirmed"),
        X.money(F.coalesce(F.sum(usd), F.lit(0.0))).alias("Amount"))
    g = g.withColumns({c: F.upper(c) for c in ("City", "Area", "City_Final")})
    comp = F.broadcast(competition.select(F.upper("City_Final").alias("City_Final"), "Competencia"))  # sheet rows
    g = g.join(comp, "City_Final", "left").withColumn("Competencia", F.coalesce("Competencia", F.lit("-")))
    return g.withColumn("Cruce", F.concat(F.col("City"), F.lit("-"), F.col("Area")))


def discount_mix_by_country(mix: DataFrame) -> DataFrame:
    """D35 zone form, country view: Confirmed and Amount per month, country, type and payer."""
    return mix.groupBy("Month", "Country", "Discount_Type", "Paid_By").agg(
        F.coalesce(F.sum("Confirmed"), F.lit(0)).alias("Confirmed"), F.coalesce(F.sum("Amount"), F.lit(0.0)).alias("Amount"))
