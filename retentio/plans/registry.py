"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each wraps a library operator with the fixed parameters of ``defaults``.
Published money columns are rounded to cents and ratios kept as doubles, so
the Spark result and the oracle can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import rules as R
from ..functions import windows as W
from ..operators import boards, cohorts, curves, lifecycle, matcher, population, spend
from ..sources import lookups as L
from ..sources.adapter import Model, stored_model
from ..sources.tables import load_tables
from .defaults import AS_OF, EARLY, EVENTS_END, EVENTS_START, sheets_folder, today
from .guards import broadcast_if_small

REGISTRY: dict[str, Callable[[Model], DataFrame]] = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def publish(df: DataFrame, money=(), digits: int = 2) -> DataFrame:
    """Round money columns to cents and publish them as doubles (``exprs.money``)."""
    return df.withColumns({c: X.money(c, digits) for c in money})


def _mw(default=AS_OF):
    return W.month_windows(today(default))


_SHEETS: dict = {}


def _sheets(m):
    """Rule, tax, zone and block sheets; loaded and checked once per session and folder."""
    spark = m.spark
    key = (spark.sparkContext.applicationId, sheets_folder())
    if key not in _SHEETS:
        sheets = L.load_sheets(spark, sheets_folder())
        # sheets may come from storage: broadcast them only after a size check
        tax = broadcast_if_small(R.prepare_tax(sheets["tax"], sheets["rename"]), 100_000)
        zones = broadcast_if_small(R.prepare_zones(sheets["zones"]), 100_000)
        _SHEETS[key] = (R.rules_from_frame(sheets["rules"]), tax, zones, sheets["block"])
    return _SHEETS[key]


# ------------------------------------------------------------------ boards
@query("monthly_kpis")
def _monthly_kpis(m):
    mw = _mw()
    return boards.monthly_kpis(m, mw.itm, mw.ftm)


# ------------------------------------------------------------------ spend
@query("fx_normalize")
def _fx_normalize(m):
    start = W.n_month_start(today(), 6)
    o = boards.confirmed_orders(m, start, _mw().ftm)
    o = spend.fx_normalize(o, m, "total_amount")
    g = o.groupBy(F.col("country_name").alias("Country"), X.month_key("registered_date").alias("Month")).agg(
        F.sum("total_amount").alias("GMV"), F.sum("total_amount_usd").alias("GMV_USD"))
    return publish(g, ["GMV", "GMV_USD"])


@query("order_discounts")
def _order_discounts(m):
    start = W.first_of_month(W.add_months(today(), -2))
    return publish(spend.order_discounts(m, start, today()), ["total_disc", "total_voucher_disc"])


@query("crm_spend")
def _crm_spend(m):
    mw = _mw()
    return publish(spend.crm_spend(m, mw.itm, mw.ftm), ["Amount", "Amount_Shopper"])


def _six_weeks():
    _, fin = W.last_complete_week(today())
    start = fin - dt.timedelta(days=41)
    return start, _mw().ftm


@query("wallet_spend")
def _wallet_spend(m):
    start, end = _six_weeks()
    return publish(spend.wallet_spend(m, start, end), [
        "Used_Amount", "Used_Amount_USD", "Used_Amount_Confirmed", "Used_Amount_Confirmed_USD"])


@query("coupon_spend_daily")
def _coupon_spend_daily(m):
    start, end = _six_weeks()
    return publish(spend.coupon_spend_daily(m, start, end, W.add_months(start, -12)), [
        "Used_Amount", "Used_Amount_USD", "Used_Amount_Confirmed", "Used_Amount_Confirmed_USD"])


@query("spend_by_type_month")
def _spend_by_type_month(m):
    rules, tax, _, block = _sheets(m)
    mw = _mw()
    start = W.first_of_month(W.add_months(today(), -4))
    df = spend.spend_by_type_month(m, start, mw.flm, rules, tax, block, exclude_country="NATION_3")
    return publish(df, ["Final_AMOUNT", "Final_PERCENTAGE"])


@query("spend_by_zone")
def _spend_by_zone(m):
    rules, tax, zones, block = _sheets(m)
    return publish(spend.spend_by_zone(m, today(), rules, tax, zones, block), ["Final", "Final RR"])


# ------------------------------------------------------------------ lifecycle
@query("month_reorder")
def _month_reorder(m):
    return lifecycle.month_reorder(m, today())


@query("vertical_trials")
def _vertical_trials(m):
    mw = _mw(EARLY)
    return lifecycle.vertical_trials(m, today(EARLY), mw.itm, mw.ftm)


@query("desired_returns")
def _desired_returns(m):
    return lifecycle.desired_returns(m, today())


@query("reactivations")
def _reactivations(m):
    return lifecycle.reactivations(m, today())


@query("country_scorecard")
def _country_scorecard(m):
    return boards.country_scorecard(m, today(EARLY))


@query("crm_scorecard")
def _crm_scorecard(m):
    rules, tax, _, block = _sheets(m)
    mw = _mw()
    df = boards.crm_scorecard(spend.crm_spend(m, mw.itm, mw.ftm), today(), rules, tax, block)
    return publish(df, ["Final", "Final RR"])


@query("central_budget_totals")
def _central_budget_totals(m):
    """AG16: totals of the CENTRAL budget in this month's CRM scorecard."""
    rules, tax, _, block = _sheets(m)
    mw = _mw()
    df = boards.crm_scorecard(spend.crm_spend(m, mw.itm, mw.ftm), today(), rules, tax, block)
    tot = boards.filtered_totals(df, F.col("Budget") == "CENTRAL", ["Final", "Orders_CRM", "Acq_CRM"])
    return publish(tot, ["Final"])


@query("run_rate")
def _run_rate(m):
    """The run-rate frame joined to this month's confirmed orders per country (projection)."""
    mw = _mw()
    k = boards.monthly_kpis(m, mw.itm, mw.ftm)
    rr = W.run_rate(today())
    return k.select("Country", "Orders", F.lit(rr).alias("rr"), F.bround(F.col("Orders") / F.lit(rr), 0).alias("Orders RR"))


# ------------------------------------------------------------------ cohorts
COHORT_MONEY = ["Original_Amount_Used", "Original_Amount_Used_USD"] + [f"{b}_{x}" for b in ("M1", "M2", "M3") for x in (
    "Revenue", "Revenue_USD", "Total_Paid", "Total_Paid_USD", "Total_Disc", "Total_Disc_USD", "Total_Voucher_Disc",
    "Total_Voucher_Disc_USD", "Amount_Used", "Amount_Used_USD")]


def _money_in(df, names=COHORT_MONEY):
    return [c for c in names if c in df.columns]


@query("campaign_cohorts")
def _campaign_cohorts(m):
    return cohorts.campaign_cohorts(m, today())


@query("cohort_retention_rates")
def _cohort_retention_rates(m):
    return cohorts.cohort_retention_rates(cohorts.campaign_cohorts(m, today()))


@query("campaign_cohort_value")
def _campaign_cohort_value(m):
    df = cohorts.campaign_cohort_value(m, today(), "voucher", exclude_like=L.EXCLUDE_LIKE_FIXTURE)
    return publish(df, _money_in(df))


@query("campaign_cohort_value_variations")
def _campaign_cohort_value_variations(m):
    df = cohorts.campaign_cohort_value(m, today(), "variations", exclude_like=L.EXCLUDE_LIKE_FIXTURE)
    return publish(df, _money_in(df))


@query("campaign_cohort_value_coupon")
def _campaign_cohort_value_coupon(m):
    df = cohorts.campaign_cohort_value(m, today(), "coupon")
    return publish(df, _money_in(df))


@query("mature_cohorts")
def _mature_cohorts(m):
    rules, _, _, _ = _sheets(m)
    df = cohorts.campaign_cohort_value(m, today(), "voucher", exclude_like=L.EXCLUDE_LIKE_FIXTURE)
    out = cohorts.mature_cohorts(df, ["Country", "City", "Campaign", "Discount_Type", "Variation"], rules)
    return publish(out, _money_in(out))


@query("adr_after_campaign")
def _adr_after_campaign(m):
    df = cohorts.adr_after_campaign(m, today(), like="%BRAND1%")
    return publish(df, ["Total_Paid", "Total_Disc", "Total_Voucher_Disc", "Total_Amount_Used", "Total_Paid_USD",
                        "Total_Disc_USD", "Total_Voucher_Disc_USD", "Total_Amount_Used_USD"])


def model_for(spark: SparkSession, sf_dir: str) -> Model:
    """The logical model over ``sf_dir``; its large views are stored once per session.

    Warehouse timestamps are UTC instants; local times are derived explicitly
    per country (``from_utc_timestamp``), so the session clock is UTC.
    """
    if spark.conf.get("spark.sql.session.timeZone", "UTC") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return stored_model(spark, lambda: load_tables(spark, sf_dir), sf_dir)


# ------------------------------------------------------------------ coupons and vouchers
PERF_MONEY = ["Used_Amount_Confirmed", "Used_Amount_Confirmed_Shopper", "Used_Amount_Confirmed_USD",
              "Used_Amount_Confirmed_USD_Shopper", "Used_Final_USD", "Used_Final"]
# The report's columns.
STATS_COLS = ["Country", "City", "Campaign", "Acq_M1", "Acq_M2", "Acq_M3", "Acquisitions", "M1_Orders",
              "M1_Orders_Final", "M1_Total_Disc", "M1_Total_Paid", "M1_Total_Voucher_Disc", "M1_Users",
              "M1_Users_Final", "M2_Orders", "M2_Orders_Final", "M2_Total_Disc", "M2_Total_Paid",
              "M2_Total_Voucher_Disc", "M2_Users", "M2_Users_Final", "M3_Orders", "M3_Orders_Final",
              "M3_Total_Disc", "M3_Total_Paid", "M3_Total_Voucher_Disc", "M3_Users", "M3_Users_Final",
              "Original_Amount_Used"]


@query("coupon_performance")
def _coupon_performance(m):
    df = spend.coupon_performance(m, today())
    return publish(df, [c for c in PERF_MONEY if c in df.columns])


def _performance_joined(m):
    rules, tax, _, block = _sheets(m)
    perf = spend.coupon_performance_final(spend.coupon_performance(m, today()), rules, tax, block)
    st = cohorts.campaign_cohort_value(m, today(), "coupon")
    pt = cohorts.mature_cohorts(st, ["Country", "City", "Campaign"], rules,
                                filters=cohorts.CLASS_FILTERS + ["TRIAL"], block=block)
    return spend.performance_joined(perf, pt, cols=STATS_COLS)


@query("performance_joined")
def _performance_joined_q(m):
    df = _performance_joined(m)
    return publish(df, [c for c in PERF_MONEY + COHORT_MONEY if c in df.columns])


@query("campaign_type_catalog")
def _campaign_type_catalog(m):
    rules, tax, _, block = _sheets(m)  # the classes come from the performance side alone
    return spend.campaign_type_catalog(spend.coupon_performance_final(spend.coupon_performance(m, today()), rules, tax, block))


@query("active_flows")
def _active_flows(m):
    return spend.active_flows(m, today())


@query("active_flows_vouchers")
def _active_flows_vouchers(m):
    return spend.active_flows_vouchers(m, today(), exclude_like=L.EXCLUDE_LIKE_FIXTURE)


@query("active_flows_board")
def _active_flows_board(m):
    rules, _, _, _ = _sheets(m)
    flows = spend.active_flows_vouchers(m, today(), exclude_like=L.EXCLUDE_LIKE_FIXTURE)
    return spend.active_flows_board(flows, rules)


@query("validity_with_stats")
def _validity_with_stats(m):
    rules, tax, _, _ = _sheets(m)
    val = spend.voucher_validity_daily(m, today(), exclude_like=L.EXCLUDE_LIKE_FIXTURE)
    val = val.withColumns({"Ageing": F.round("Ageing", 6), "Availability": F.round("Availability", 6)})
    st = cohorts.campaign_cohort_value(m, today(), "variations", exclude_like=L.EXCLUDE_LIKE_FIXTURE)
    pt = cohorts.mature_cohorts(st, ["Country", "City", "Campaign", "Discount_Type", "Variation"], rules)
    df = spend.validity_with_stats(val, pt, rules, tax)
    return publish(df, [c for c in df.columns if c in (
        "Confirmed_Used_Amount", "Confirmed_Used_Amount_Iva", "Confirmed_Used_Amount_Final", *COHORT_MONEY)])


@query("voucher_validity_daily")
def _voucher_validity_daily(m):
    df = spend.voucher_validity_daily(m, today(), exclude_like=L.EXCLUDE_LIKE_FIXTURE)
    df = df.withColumns({"Ageing": F.round("Ageing", 6), "Availability": F.round("Availability", 6)})
    return publish(df, ["Confirmed_Used_Amount", "Confirmed_Used_Amount_USD", "Confirmed_Used_Amount_Iva",
                        "Confirmed_Used_Amount_USD_Iva"])


# ------------------------------------------------------------------ dashboard, no-return
EUR_MONEY = ["Confirmed_Revenue", "Confirmed_Revenue_Log", "GFV_Gross_Log", "GMV_Gross_Mktp", "GFV_Gross_Total",
             "DF_No_Discount_Total", "DF_No_Discount_Log", "Discounts_Company_Total"]


def _six_months():
    return W.n_month_start(today(), 6), _mw().ftm


@query("order_funnel")
def _order_funnel(m):
    return publish(boards.order_funnel(m, *_six_months()), EUR_MONEY)


@query("partner_status")
def _partner_status(m):
    return boards.partner_status(m, *_six_months())


@query("business_board")
def _business_board(m):
    start, end = _six_months()
    return publish(boards.business_board(boards.order_funnel(m, start, end), boards.partner_status(m, start, end)),
                   EUR_MONEY)


@query("discount_mix")
def _discount_mix(m):
    return boards.discount_mix(m, *_six_months())


@query("discount_mix_zone")
def _discount_mix_zone(m):
    return boards.discount_mix(m, *_six_months(), by=("Country", "City", "Area"))


@query("discount_mix_pivot")
def _discount_mix_pivot(m):
    df = boards.discount_mix_pivot(boards.discount_mix(m, *_six_months()))
    return publish(df, ["FREE_DELIVERY", "JOKER", "VOUCHER", "Total"])


def _mix_competition(m):
    comp = broadcast_if_small(L.city_competition_frame(m.spark), 100_000)
    return boards.discount_mix_competition(m, W.first_of_month(W.add_months(today(), -3)), comp, L.BIG_CITY)


@query("discount_mix_competition")
def _discount_mix_competition(m):
    return _mix_competition(m)


@query("discount_mix_by_country")
def _discount_mix_by_country(m):
    return publish(boards.discount_mix_by_country(_mix_competition(m)), ["Amount"])


@query("no_return")
def _no_return(m):
    return lifecycle.no_return(m, today())


@query("reactivation_profile")
def _reactivation_profile(m):
    return lifecycle.reactivation_profile(m, today())


# ------------------------------------------------------------------ trials, heavy users, bands
@query("vertical_trials_by_campaign")
def _vertical_trials_by_campaign(m):
    mw = _mw(EARLY)
    return lifecycle.vertical_trials_by_campaign(m, today(EARLY), [mw.itm, mw.ilm])


@query("heavy_users_repeat")
def _heavy_users_repeat(m):
    # no user reaches 7 orders in a month in the test orders: threshold 2 exercises both branches
    return lifecycle.heavy_users_repeat(m, today(), threshold=2)


@query("heavy_users_repeat_events")
def _heavy_users_repeat_events(m):
    return lifecycle.heavy_users_repeat_events(m.t["events"], m, EVENTS_START, EVENTS_END, threshold=7)


@query("frequency_bands")
def _frequency_bands(m):
    return lifecycle.frequency_bands(m, W.first_of_month(W.add_months(today(), -4)), _mw().flm)


# ------------------------------------------------------------------ clusters, competition, boards
def _adr_raw(m):
    mw = _mw()
    return lifecycle.adr_user_clusters(m, today(), new_since=mw.ilm, orders_from=W.first_of_month(W.add_months(today(), -2)),
                                       orders_to=mw.ftm)


@query("adr_user_clusters")
def _adr_user_clusters(m):
    return publish(_adr_raw(m), ["GMV", "Amount", "Amount_Shopper"])


@query("adr_cluster_board")
def _adr_cluster_board(m):
    rules, tax, zones, block = _sheets(m)
    df = lifecycle.adr_cluster_board(_adr_raw(m), rules, tax, zones, block)
    return publish(df, ["GMV", "Final"]).withColumn("Cluster_Users", F.round("Cluster_Users", 6))


@query("competition_spend")
def _competition_spend(m):
    rules, tax, zones, block = _sheets(m)
    df = spend.competition_spend(m, _mw().ilm, rules, tax, zones, block)
    return publish(df, ["Spend"])


@query("spend_reconciliation")
def _spend_reconciliation(m):
    rules, tax, _, block = _sheets(m)
    mw = _mw()
    df = spend.spend_reconciliation(m, mw.ilm, mw.flm, rules, tax, block)
    return publish(df, ["Final_Detail", "Final_Daily", "Final_Diff"])


@query("user_city_based")
def _user_city_based(m):
    return boards.user_city_based(m)


@query("user_city_distribution")
def _user_city_distribution(m):
    return boards.user_city_distribution(m)


@query("voucher_order_audit")
def _voucher_order_audit(m):
    mw = _mw()
    return boards.voucher_order_audit(m, mw.ilm, mw.flm)


@query("weekly_orders_board")
def _weekly_orders_board(m):
    return boards.weekly_orders_board(m, today())


@query("weekly_spend_board")
def _weekly_spend_board(m):
    rules, tax, _, block = _sheets(m)
    return publish(boards.weekly_spend_board(m, today(), rules, tax, block), [
        "Used_Amount", "Used_Amount_USD", "Used_Amount_Confirmed", "Used_Amount_Confirmed_USD", "Used_Final",
        "Used_USD_Final"])


# ------------------------------------------------------------------ curves
CURVE_RATIOS = ["Cum_M1", "Weekday Value", "Cum_Weekday", "Month Value", "Month M1", "%Month", "%M1"]


def _curve_window(default=AS_OF):
    mw = _mw(default)
    return W.first_of_month(W.add_months(today(default), -3)), mw.flm, mw.ftm


def _m1_curve(m):
    start, end, oend = _curve_window(EARLY)
    return curves.reorder_curve(curves.curve_points(m, start, end, oend, "M1"), "M1_Fecha", "Acq")


def _round(df, cols, digits):
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols if c in df.columns})


@query("reorder_curve_m1")
def _reorder_curve_m1(m):
    return _round(_m1_curve(m), CURVE_RATIOS, 9)


@query("reorder_curve")
def _reorder_curve(m):
    start, end, oend = _curve_window()
    df = curves.reorder_curve(curves.curve_points(m, start, end, oend, "Reorder"), "Reorder_Fecha", "Users")
    return _round(df, CURVE_RATIOS, 9)


@query("curve_month_summary")
def _curve_month_summary(m):
    start, end, oend = _curve_window()
    return curves.curve_month_summary(curves.curve_points(m, start, end, oend, "Reorder"), "Reorder_Fecha", "Users")


@query("curve_fit_cubic")
def _curve_fit_cubic(m):
    fit = curves.curve_fit_cubic(_m1_curve(m))
    return _round(fit, ["A", "B", "C", "D", "A_Media", "B_Media", "C_Media", "D_Media"], 6)


def _reo_curve(m):
    start, end, oend = _curve_window()
    return curves.reorder_curve(curves.curve_points(m, start, end, oend, "Reorder"), "Reorder_Fecha", "Users")


@query("curve_fit_cubic_reorder")
def _curve_fit_cubic_reorder(m):
    fit = curves.curve_fit_cubic(_reo_curve(m))
    return _round(fit, ["A", "B", "C", "D", "A_Media", "B_Media", "C_Media", "D_Media"], 6)


@query("curve_fit_r2_reorder")
def _curve_fit_r2_reorder(m):
    c = _reo_curve(m).checkpoint(eager=True)  # read twice: fit and residuals
    return _round(curves.curve_r2(c, curves.curve_fit_cubic(c), "Reorder"), ["R_Sq"], 6)


@query("curve_fit_r2")
def _curve_fit_r2(m):
    c = _m1_curve(m).checkpoint(eager=True)  # read twice: fit and residuals
    return _round(curves.curve_r2(c, curves.curve_fit_cubic(c), "M1"), ["R_Sq"], 6)


# ------------------------------------------------------------------ migrated population
# the population's migration starts with the data: its queries cover the whole order history
POP_SINCE = dt.date(1995, 1, 1)


@query("calendar_cohorts")
def _calendar_cohorts(m):
    return population.calendar_cohorts(m, POP_SINCE, today())


@query("migrated_users_monthly")
def _migrated_users_monthly(m):
    return population.migrated_users_monthly(m, POP_SINCE, _mw().ftm, today())


@query("migrated_coupon_spend")
def _migrated_coupon_spend(m):
    rules, tax, _, block = _sheets(m)
    df = population.migrated_coupon_spend(m, POP_SINCE, W.add_months(POP_SINCE, -12), rules, tax, block)
    return publish(df, ["Amount_Final"])


@query("country_coupon_spend")
def _country_coupon_spend(m):
    rules, tax, _, block = _sheets(m)
    return publish(population.country_coupon_spend(m, POP_SINCE, rules, tax, block), ["Amount_Final"])


@query("legacy_users_current_orders")
def _legacy_users_current_orders(m):
    return population.legacy_users_current_orders(m, EVENTS_START, EVENTS_END, W.first_of_month(W.add_months(today(), -6)))


@query("legacy_frequency_segments")
def _legacy_frequency_segments(m):
    return population.legacy_frequency_segments(m, EVENTS_START, EVENTS_END)


@query("campaign_classes")
def _campaign_classes(m):
    """D15 on its own: every campaign with its classes."""
    names = spend.clean_campaign_frame(m.campaigns().select(F.col("campaign_name").alias("Campaign")), ["Campaign"]).distinct()
    return matcher.attach_classes(names, "Campaign", L.load_sheets(m.spark, sheets_folder())["rules"])


@query("country_net_spend")
def _country_net_spend(m):
    """D16 on its own: the month's benefits per country, the shop's part net of tax."""
    _, tax, _, _ = _sheets(m)
    mw = _mw()
    g = spend.crm_spend(m, mw.itm, mw.ftm).groupBy(F.coalesce(F.upper("Country"), F.lit("NONE")).alias("Country")).agg(
        F.sum("Amount").alias("Amount"), F.sum("Amount_Shopper").alias("Amount_Shopper"))
    return publish(R.net_of_tax(g, tax, "Amount_Shopper", "Amount"), ["Amount", "Amount_Shopper", "Final"])


@query("nested_discounts")
def _nested_discounts(m):
    """SF29: the repeated field of the orders, unnested; rows and amount per month, type and payer."""
    o = m.orders_nested(W.n_month_start(today(), 3), today())
    d = o.select("registered_date", F.explode("discounts").alias("d"))
    g = d.groupBy(X.month_key("registered_date").alias("Month"), F.col("d.discount_type_name").alias("Discount_Type"),
                  F.col("d.discount_paid_by").alias("Paid_By")).agg(F.count("*").alias("Discounts"), F.sum("d.discount_amount").alias("Amount"))
    return publish(g, ["Amount"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(model_for(spark, sf_dir))
    return {k: bind(v) for k, v in REGISTRY.items()}
