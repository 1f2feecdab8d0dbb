"""Migrated-population family: D7, D37, D38 (and the country coupon board next to D38).

The population is a user list (users migrated from another platform). Every
query restricts facts to it with a semi join on the user key, so nothing but
the key is shuffled from the list.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import rules as R
from . import primitives as P
from .primitives import one_row_per_order
from .spend import _usd, clean_campaign_frame, with_fx


def _pop_orders(m, since: dt.date, countries=None) -> DataFrame:
    o = X.since(m.orders(), since).filter(F.col("order_status") == "CONFIRMED")
    if "order_month" in o.columns:
        o = o.filter(F.col("order_month") >= F.trunc(F.lit(since), "MM"))
    if countries is not None:
        o = o.filter(F.col("country_name").isin(countries))
    return o.join(m.population(), "user_id", "left_semi")


def calendar_cohorts(m, since: dt.date, as_of: dt.date, countries=None) -> DataFrame:
    """Acquisitions of the population per month and how many ordered again 1, 2 and 3
    calendar months later (month boundaries crossed, SF15).

    A user has one acquisition, so joining follow-ups on the user key is
    linear in the user's orders (no pairs within a user).
    """
    o = _pop_orders(m, since, countries)
    acq = o.filter(F.col("is_acquisition") == 1).select("user_id", F.col("country_name").alias("country"),
                                                       F.col("registered_date").alias("fecha"))
    fol = o.filter(F.col("registered_date") <= F.lit(as_of)).select("user_id", F.col("registered_date").alias("o_date"))
    j = acq.join(fol, "user_id").filter(F.col("o_date") >= F.date_add("fecha", 1))
    j = j.withColumn("cm", X.months_between_boundaries("fecha", "o_date"))
    per_user = j.groupBy(X.month_key("fecha").alias("Month"), F.col("country").alias("Country"), "user_id").agg(
        *[F.max(F.when(F.col("cm") == k, 1).otherwise(0)).alias(f"m{k}") for k in (1, 2, 3)])
    act = per_user.groupBy("Month", "Country").agg(
        *[F.sum(f"m{k}").cast("long").alias(f"Active_Pop_M{k}") for k in (1, 2, 3)])
    size = acq.groupBy(X.month_key("fecha").alias("Month"), F.col("country").alias("Country")).agg(
        F.count_distinct("user_id").alias("Pop_Acq"))
    out = act.join(size, ["Month", "Country"], "left").withColumn("Pop_Acq", F.coalesce("Pop_Acq", F.lit(0)))
    return out.select("Month", "Country", "Pop_Acq", "Active_Pop_M1", "Active_Pop_M2", "Active_Pop_M3")


def migrated_users_monthly(m, since: dt.date, end: dt.date, as_of: dt.date, countries=None) -> DataFrame:
    """Month x country grid of the population: users, acquisitions and orders, the
    D7 returning users, and all confirmed orders and acquisitions of the country (JN17, JN13)."""
    cn = m.countries().select("country_id", F.col("country_name").alias("Country"))
    if countries is not None:
        cn = cn.filter(F.col("Country").isin(countries))
    grid = P.densify_months(cn, since, end, "month").select("Country", X.month_key("month").alias("Month"))
    pop_users = (m.users().join(m.population(), "user_id", "left_semi")
                 .join(cn, "country_id").groupBy("Country").agg(F.count_distinct("user_id").alias("Total_Pop_Users")))
    o = _pop_orders(m, since, countries)
    po = o.groupBy(F.col("country_name").alias("Country"), X.month_key("registered_date").alias("Month")).agg(
        F.count_distinct(F.when(F.col("is_acquisition") == 1, F.col("user_id"))).alias("Pop_Acq"),
        F.count(F.lit(1)).alias("Confirmed_Pop_Orders"))
    gen = grid.join(pop_users, "Country", "left").join(po, ["Country", "Month"], "left")
    gen = gen.fillna(0, subset=["Total_Pop_Users", "Pop_Acq", "Confirmed_Pop_Orders"])
    coh = calendar_cohorts(m, since, as_of, countries).drop("Pop_Acq")
    tot = X.since(m.orders(), since).filter(F.col("order_status") == "CONFIRMED")
    if countries is not None:
        tot = tot.filter(F.col("country_name").isin(countries))
    tot = tot.groupBy(X.month_key("registered_date").alias("Month"), F.col("country_name").alias("Country")).agg(
        F.count(F.lit(1)).alias("Confirmed_Totales"), F.sum("is_acquisition").cast("long").alias("Acq_Totales"))
    up = lambda df: df.withColumns({"Country": F.coalesce(F.upper("Country"), F.lit("NONE")),
                                    "Month": F.coalesce(F.upper("Month"), F.lit("NONE"))})
    final = up(gen).join(up(coh), ["Month", "Country"], "left").join(up(tot), ["Month", "Country"], "left")
    nums = [c for c in final.columns if c not in ("Month", "Country")]
    return final.fillna(0, subset=nums)


def migrated_coupon_spend(m, since: dt.date, created_from: dt.date, rules: dict, tax: DataFrame, block,
                          countries=None) -> DataFrame:
    """The population's coupon spend (USD, by payer) classified, netted of tax, per month,
    country, budget, type and segment."""
    o = X.since(m.orders(), since).join(m.population(), "user_id", "left_semi")
    if countries is not None:
        o = o.filter(F.col("country_name").isin(countries))
    c = X.in_months(m.coupons(), since).filter(F.to_date("created_at") >= F.lit(created_from)).select(
        "order_id", "coupon_id", "campaign_id", "used_amount")
    j = with_fx(o.join(c, "order_id"), m)
    conf = F.col("order_status") == "CONFIRMED"
    tot, oth = conf & (F.col("payment_mode") == "TOTAL_AMOUNT"), conf & (F.col("payment_mode") != "TOTAL_AMOUNT")
    usd = _usd("used_amount")
    spent = {"Used_Amount_Confirmed_USD": F.when(tot, usd).otherwise(F.lit(0.0)),
             "Used_Amount_Confirmed_USD_Shopper": F.when(oth, usd).otherwise(F.lit(0.0))}
    j = one_row_per_order(j.withColumn("_conf", conf), [F.col("country_name").alias("country"), X.month_key("registered_date").alias("month"),
                                                        "campaign_id", "coupon_id"], ["_conf", "is_acquisition"], spent)
    g = j.groupBy("country", "month", "campaign_id").agg(
        F.count(F.lit(1)).alias("Redeemed"), F.count(F.when(F.col("_conf"), 1)).alias("Redeemed_Confirmed"),
        F.count(F.when(F.col("is_acquisition") == 1, 1)).alias("Acq"), *[F.sum(c).alias(c) for c in spent])
    names = m.campaigns().select("campaign_id", "campaign_name")
    g = g.join(names, "campaign_id", "left").groupBy(
        F.col("country").alias("Country"), F.col("month").alias("Month"), F.col("campaign_name").alias("Campaign")).agg(
        *[F.sum(c).alias(c) for c in ("Redeemed", "Redeemed_Confirmed", "Acq", "Used_Amount_Confirmed_USD",
                                      "Used_Amount_Confirmed_USD_Shopper")])
    g = clean_campaign_frame(g, ["Month", "Country", "Campaign"])
    g = R.classify_campaigns(g, "Campaign", rules)
    g = R.net_of_tax(g, tax, "Used_Amount_Confirmed_USD_Shopper", "Used_Amount_Confirmed_USD", "Amount_Final")
    g = R.drop_blocked(g, "Campaign", block)
    return g.groupBy("Month", "Country", "Budget", "Type", "Segment").agg(
        F.sum("Redeemed_Confirmed").alias("Redeemed_Confirmed"), F.sum("Acq").alias("Acq"),
        F.sum("Amount_Final").alias("Amount_Final"))


def country_coupon_spend(m, since: dt.date, rules: dict, tax: DataFrame, block, countries=None) -> DataFrame:
    """D38 companion: all coupon spend of the countries from the daily aggregate, per month,
    budget, type and segment; the shopper-paid part netted of tax."""
    vd = m.vouchers_daily().filter(F.col("date") >= F.lit(since))
    if countries is not None:
        vd = vd.filter(F.col("country_name").isin(countries))
    cn = m.countries().select(F.col("country_name").alias("_cn"), "currency_id")
    j = with_fx(vd.join(cn, F.col("country_name") == F.col("_cn"), "left"), m, "date")
    g = j.groupBy(X.month_key("date").alias("Month"), F.col("country_name").alias("Country"),
                  F.col("campaign_name").alias("Campaign"),
                  F.when(F.col("payment_shopper") == 1, "Si").otherwise("No").alias("Shopper")).agg(
        F.sum("coupons_redeemed_confirmed").alias("Redeemed_Confirmed"),
        F.sum("coupon_orders_acq_confirmed").alias("Acquisitions"),
        F.sum(_usd("coupon_used_amount_confirmed")).alias("Amount_USD"))
    g = clean_campaign_frame(g, ["Month", "Country", "Campaign", "Shopper"])
    g = R.classify_campaigns(g, "Campaign", rules)
    g = R.attach_tax(g, tax)
    g = R.drop_blocked(g, "Campaign", block)
    g = g.withColumn("Amount_Final", F.when(F.col("Shopper") == "NO", F.col("Amount_USD") / (F.lit(1.0) + F.col("IVA"))
                                            * F.col("Extra")).when(F.col("Shopper") == "SI", F.col("Amount_USD")))
    return g.groupBy("Month", "Country", "Budget", "Type", "Segment").agg(
        F.sum("Redeemed_Confirmed").alias("Redeemed_Confirmed"), F.sum("Acquisitions").alias("Acquisitions"),
        F.coalesce(F.sum("Amount_Final"), F.lit(0.0)).alias("Amount_Final"))


def legacy_frequency_segments(m, start: dt.date, end: dt.date, threshold: int = 7) -> DataFrame:
    """D30 (segment form): users of the old platform per month by segment, loyalty and order band
    (at or above ``threshold``), then per (month, loyalty, band) with shares of the month (WN4)."""
    lo = m.legacy_orders().filter((F.col("order_status") == "CONFIRMED")
                                  & F.col("order_date").between(F.lit(start), F.lit(end)))
    ut = (lo.groupBy(X.month_key("order_date").alias("month"), "user_id").agg(F.sum("qty_orders").alias("orders"))
          .join(m.legacy_segments(), "user_id", "left"))
    seg = ut.groupBy(F.col("month").alias("Month"), F.coalesce("segment", F.lit("-")).alias("Segment"),
                     F.when(F.upper("segment").like("%LOYAL%"), "Loyal").otherwise("No Loyal").alias("Loyalty"),
                     F.when(F.col("orders") >= threshold, "+7").otherwise("-7").alias("Tipo")).agg(
        F.count(F.lit(1)).alias("Users"), F.sum("orders").cast("long").alias("Orders"))
    pt = seg.groupBy("Month", "Loyalty", "Tipo").agg(F.sum("Users").alias("Users"), F.sum("Orders").alias("Orders"))
    return pt.withColumns({
        "%Orders": P.share_of_group("Orders", ["Month"]),
        "%Users": P.share_of_group("Users", ["Month"]),
        "Freq": X.safe_ratio("Orders", "Users"),
    })


def legacy_users_current_orders(m, legacy_start: dt.date, legacy_end: dt.date, since: dt.date,
                                country: str | None = None, threshold: int = 7) -> DataFrame:
    """D30 (current-platform form): confirmed users and orders on this platform per month, by the
    user's legacy segment and legacy order band (bands from the old platform's orders in the
    legacy window), then per (month, loyalty, band) with shares of the month."""
    lo = m.legacy_orders().filter((F.col("order_status") == "CONFIRMED")
                                  & F.col("order_date").between(F.lit(legacy_start), F.lit(legacy_end)))
    ut = lo.groupBy("user_id").agg(F.sum("qty_orders").alias("legacy_orders"))
    o = X.since(m.orders(), since)
    if "order_month" in o.columns:
        o = o.filter(F.col("order_month") >= F.trunc(F.lit(since), "MM"))
    if country is not None:
        o = o.filter(F.col("country_name") == country)
    j = o.join(m.legacy_segments(), "user_id", "left").join(ut, "user_id", "left")
    conf = F.col("order_status") == "CONFIRMED"
    g = j.groupBy(X.month_key("registered_date").alias("Month"), F.coalesce("segment", F.lit("-")).alias("Segment"),
                  F.when(F.upper("segment").like("%LOYAL%"), "Loyal").otherwise("No Loyal").alias("Loyalty"),
                  F.when(F.col("legacy_orders") >= threshold, "+7").otherwise("-7").alias("Tipo")).agg(
        F.count_distinct(F.when(conf, F.col("user_id"))).alias("Users"),
        F.count(F.when(conf, 1)).alias("Orders"))
    pt = g.groupBy("Month", "Loyalty", "Tipo").agg(F.sum("Users").alias("Users"), F.sum("Orders").alias("Orders"))
    return pt.withColumns({
        "%Orders": P.share_of_group("Orders", ["Month"]),
        "%Users": P.share_of_group("Users", ["Month"]),
        "Freq": X.safe_ratio("Orders", "Users"),
    })
