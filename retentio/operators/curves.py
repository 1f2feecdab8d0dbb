"""Re-order curves (D31) and their cubic fit.

D31: for a cohort month (acquisitions, or active non-acquired users), the
first order date in the following calendar month, as a cumulative share of the
cohort, next to the weekday-weighted share of that month elapsed.

D32: a least-squares cubic y = a x^3 + b x^2 + c x + d through (0, 0) and the
curve points of each (country, month). The reference calls a general
non-linear solver; a cubic is linear in its coefficients, so the fit is the
4 x 4 normal equations. Each group contributes power sums (sum x^k for
k <= 6, sum x^k y for k <= 3) computed by ``groupBy.agg`` (partial
aggregation, no data brought together), and the system is solved with
Cramer's rule in column arithmetic. x lies in [0, 1], so the system is well
conditioned. Fewer than four distinct x values -> null coefficients.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X


def _next_month_first(m, users: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """First confirmed order date of each (user, cohort month) in the calendar month after it.

    An equi join on (user, month) against per-user monthly minima replaces the
    reference's range condition.
    """
    o = X.in_window(m.orders(), start, end).filter(F.col("order_status") == "CONFIRMED")
    first = o.groupBy("user_id", F.trunc("registered_date", "MM").alias("o_month")).agg(
        F.min("registered_date").alias("first_date"))
    u = users.withColumn("o_month", F.add_months("cohort_month", 1))
    return u.join(first, ["user_id", "o_month"])


def curve_points(m, start: dt.date, end: dt.date, orders_end: dt.date, kind: str = "M1") -> DataFrame:
    """Raw curve rows (SQL level): Month, Country, [Voucher,] date, cohort size, reorders."""
    if kind == "M1":
        inc = X.in_months(m.coupons(), start, end).select("order_id").distinct().withColumn("_v", F.lit(True))
        acq = (X.in_window(m.orders(), start, end).filter(F.col("is_acquisition") == 1)
               .join(inc, "order_id", "left")
               .select("user_id", F.col("country_name").alias("country"),
                       F.trunc("registered_date", "MM").alias("cohort_month"),
                       F.when(F.col("_v").isNotNull(), "Con Voucher").otherwise("Sin Voucher").alias("voucher")))
        keys = ["cohort_month", "country", "voucher"]
        size = acq.groupBy(*keys).agg(F.count_distinct("user_id").alias("Acq"))
        firsts = _next_month_first(m, acq, start, orders_end)
        rows = firsts.groupBy(*keys, "first_date").agg(F.count_distinct("user_id").alias("Reorders"))
        out = rows.join(size, keys, "left").withColumn("Acq", F.coalesce("Acq", F.lit(0)))
        return out.select(X.month_key("cohort_month").alias("Month"), F.col("country").alias("Country"),
                          F.col("voucher").alias("Voucher"), F.col("first_date").alias("M1_Fecha"), "Acq", "Reorders")
    o = X.in_window(m.orders(), start, end).filter(F.col("order_status") == "CONFIRMED")
    ut = o.groupBy("user_id", F.trunc("registered_date", "MM").alias("cohort_month"),
                   F.col("country_name").alias("country")).agg(F.sum(F.coalesce("is_acquisition", F.lit(0))).alias("acq"))
    ut = ut.filter(F.col("acq") == 0)
    keys = ["cohort_month", "country"]
    size = ut.groupBy(*keys).agg(F.count_distinct("user_id").alias("Users"))
    firsts = _next_month_first(m, ut, start, orders_end)
    rows = firsts.groupBy(*keys, "first_date").agg(F.count_distinct("user_id").alias("Reorders"))
    out = rows.join(size, keys, "left").withColumn("Users", F.coalesce("Users", F.lit(0)))
    return out.select(X.month_key("cohort_month").alias("Month"), F.col("country").alias("Country"),
                      F.col("first_date").alias("Reorder_Fecha"), "Users", "Reorders")


def reorder_curve(points: DataFrame, date_col: str, size_col: str, exclude_countries=(),
                  voucher: str | None = None) -> DataFrame:
    """Per (country, month, date): cumulative reorders and shares against the
    weekday-weighted elapsed share of the month (WN2, WN5, SF20).

    The cohort size of a date is summed over the voucher groups present on that
    date only (T22). Ratios with a zero denominator are null.
    """
    p = points
    if voucher is not None and "Voucher" in p.columns:
        p = p.filter(F.col("Voucher") == voucher)
    g = p.groupBy("Month", "Country", date_col).agg(F.sum(size_col).alias(size_col), F.sum("Reorders").alias("Reorders"))
    if exclude_countries:
        g = g.filter(~F.col("Country").isin(list(exclude_countries)))
    grp = ["Country", "Month"]
    w_cum = Window.partitionBy(*grp).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(*grp)
    g = g.withColumn("Cum_Reorders", F.sum("Reorders").over(w_cum))
    g = g.withColumn("Cum_M1", F.try_divide(F.col("Cum_Reorders").cast("double"), F.col(size_col).cast("double")))
    g = g.withColumn("Weekday Value", X.weekday_weight(date_col))
    g = g.withColumn("Cum_Weekday", F.sum("Weekday Value").over(w_cum))
    g = g.withColumn("Month Value", F.sum("Weekday Value").over(w_all))
    g = g.withColumn("Month M1", F.max("Cum_M1").over(w_all))
    g = g.withColumn("%Month", F.try_divide(F.col("Cum_Weekday"), F.col("Month Value")))
    g = g.withColumn("%M1", F.try_divide(F.col("Cum_M1"), F.col("Month M1")))
    return g.withColumn(date_col, F.date_format(date_col, "yyyy-MM-dd"))


# ---------------------------------------------------------------- D32
def _det3(a):
    return (a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1])
            - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0])
            + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0]))


def det4(a):
    """Determinant of a 4 x 4 matrix of numbers, Columns or SQL terms (Laplace on the first row)."""
    total = None
    for j in range(4):
        minor = [[a[r][c] for c in range(4) if c != j] for r in range(1, 4)]
        term = a[0][j] * _det3(minor)
        if total is None:
            total = term
        elif j % 2:
            total = total - term
        else:
            total = total + term
    return total


def cubic_from_sums(S, T):
    """Coefficients (a, b, c, d) of the least-squares cubic from power sums.

    ``S[k]`` = sum x^k (k = 0..6), ``T[k]`` = sum x^k y (k = 0..3). Unknown
    order (d, c, b, a): normal matrix N[i][j] = S[i + j], right side T[i].
    Returns (numerators, determinant) so callers divide safely.
    """
    N = [[S[i + j] for j in range(4)] for i in range(4)]
    det = det4(N)
    nums = []
    for col in range(4):
        Mc = [[(T[i] if j == col else N[i][j]) for j in range(4)] for i in range(4)]
        nums.append(det4(Mc))
    d, c, b, a = nums
    return (a, b, c, d), det


def curve_fit_cubic(curve: DataFrame, x: str = "%Month", y: str = "%M1") -> DataFrame:
    """Cubic through (0, 0) and the curve points of each (Country, Month), plus the country
    mean of each coefficient (AG17)."""
    pts = curve.select("Country", "Month", F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    pts = pts.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    xs = F.col("x")
    aggs = [F.count(F.lit(1)).alias("n"), F.count_distinct("x").alias("nd")]
    aggs += [F.sum(F.pow(xs, k)).alias(f"s{k}") for k in range(1, 7)]
    aggs += [F.sum(F.pow(xs, k) * F.col("y")).alias(f"t{k}") for k in range(0, 4)]
    g = pts.groupBy("Country", "Month").agg(*aggs)
    # the added (0, 0) point: one more row for S0; it adds nothing to the other sums
    S = [F.col("n") + 1] + [F.col(f"s{k}") for k in range(1, 7)]
    T = [F.col(f"t{k}") for k in range(0, 4)]
    (a, b, c, d), det = cubic_from_sums(S, T)
    ok = (F.col("nd") + F.lit(1)) >= 4  # distinct x including the added 0 (x > 0 on the curve)
    coef = {k: F.when(ok, F.try_divide(v, det)) for k, v in zip("ABCD", (a, b, c, d))}
    g = g.select("Country", "Month", *[v.alias(k) for k, v in coef.items()])
    w = Window.partitionBy("Country")
    return g.withColumns({f"{k}_Media": F.avg(k).over(w) for k in "ABCD"})


def curve_r2(curve: DataFrame, fit: DataFrame, tipo: str, x: str = "%Month", y: str = "%M1") -> DataFrame:
    """R^2 of the country mean curve on each month's points (with the (0, 0) point)."""
    pts = curve.select("Country", "Month", F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    pts = pts.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    means = fit.select("Country", "A_Media", "B_Media", "C_Media", "D_Media").distinct()
    j = pts.join(F.broadcast(means), "Country", "left")
    fx = ((F.col("A_Media") * F.col("x") + F.col("B_Media")) * F.col("x") + F.col("C_Media")) * F.col("x") + F.col("D_Media")
    j = j.withColumn("res", F.col("y") - fx)
    g = j.groupBy("Country", "Month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.sum(F.col("res") * F.col("res")).alias("ss_res"), F.first("D_Media").alias("d0"))
    # the (0, 0) point: residual -D_Media, y = 0
    n = F.col("n") + 1
    ss_res = F.col("ss_res") + F.col("d0") * F.col("d0")
    ss_tot = F.col("syy") - F.col("sy") * F.col("sy") / n
    return g.select(F.lit(tipo).alias("Tipo"), "Country", "Month",
                    (F.lit(1.0) - F.try_divide(ss_res, ss_tot)).alias("R_Sq"))


def horner(x, a, b, c, d):
    """SF28: a x^3 + b x^2 + c x + d."""
    return ((a * x + b) * x + c) * x + d


def curve_month_summary(points: DataFrame, date_col: str = "M1_Fecha", size_col: str = "Acq") -> DataFrame:
    """AG12: per (Month, Country): the median of the per-date cohort sizes, the sum of reorders
    and their ratio (M1), from the curve rows summed over voucher groups."""
    g = points.groupBy("Month", "Country", date_col).agg(F.sum(size_col).alias(size_col), F.sum("Reorders").alias("Reorders"))
    s = g.groupBy("Month", "Country").agg(F.median(size_col).alias(size_col), F.sum("Reorders").alias("Reorders"))
    return s.withColumn("M1", F.try_divide(F.col("Reorders").cast("double"), F.col(size_col)))
