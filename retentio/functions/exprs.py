"""Column expressions shared by the operators. All JVM-side."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_key(d) -> Column:
    """SF17: FORMAT_DATE('%Y-%m')."""
    return F.date_format(c(d), "yyyy-MM")


def month_start(d) -> Column:
    """SF12: DATE_TRUNC(d, MONTH) as a date."""
    return F.trunc(c(d), "MM")


def monday_week(d) -> Column:
    """SF18: EXTRACT(WEEK(MONDAY)) / ``%W``: 0-53, days before the first Monday are week 0."""
    d = c(d)
    return F.floor((F.dayofyear(d) - 1 + 7 - F.weekday(d)) / 7).cast("int")


def iso_week(d) -> Column:
    """SF19: ISO week ``%V`` (1-53)."""
    return F.weekofyear(c(d))


def months_between_boundaries(start, end) -> Column:
    """SF15: DATE_DIFF(end, start, MONTH) = month boundaries crossed (not months_between)."""
    s, e = c(start), c(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def hours_between_boundaries(start, end) -> Column:
    """SF16: DATETIME_DIFF(end, start, HOUR) = hour boundaries crossed."""
    s = F.date_trunc("hour", c(start))
    e = F.date_trunc("hour", c(end))
    return ((F.unix_timestamp(e) - F.unix_timestamp(s)) / 3600).cast("long")


def local_time(ts, tz) -> Column:
    """SF21: DATETIME(ts, zone) for a UTC timestamp."""
    return F.from_utc_timestamp(c(ts), c(tz))


def safe_ratio(num, den) -> Column:
    """SF26 / AG7: SAFE_DIVIDE in double precision (null on zero or null)."""
    return F.try_divide(c(num).cast("double"), c(den).cast("double"))


def ratio_or_zero(num, den) -> Column:
    """AG7: IFNULL(SAFE_DIVIDE(a, b), 0)."""
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def clean_number(x, default=0.0) -> Column:
    """SF7: nan / inf / -inf / null -> default."""
    x = c(x).cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(x)


def money(x, scale: int = 2) -> Column:
    """Publish a money value: snap to 6 decimals as DECIMAL, round half away from zero, double.

    Snapping first makes the rounding of a value that lies on a half cent in
    decimal terms (common for 4-decimal amounts that went through double
    arithmetic) independent of how an engine rounds binary doubles.
    """
    return F.round(c(x).cast("decimal(38,6)"), scale).cast("double")


def dsum(x) -> Column:
    """Exact sum of a money column (decimal arithmetic; no float ordering effects)."""
    return F.sum(c(x).cast("decimal(18,4)"))


def weekday_weight(d, fri=1.4, sat=1.4, sun=1.4) -> Column:
    """SF20: Friday, Saturday and Sunday weigh more in run-rate and curves."""
    w = F.weekday(c(d))
    return (F.when(w == 4, F.lit(fri)).when(w == 5, F.lit(sat)).when(w == 6, F.lit(sun))
            .otherwise(F.lit(1.0)))


def any_nonzero(cols) -> Column:
    """FLT7: keep rows where any metric differs from 0."""
    return reduce(lambda a, b: a | b, [F.coalesce(c(x) != 0, F.lit(False)) for x in cols])


def key_concat(*cols, sep: str = "-") -> Column:
    """PRJ8 / SF2: composite key ``a-b-c``; null if any part is null (warehouse CONCAT)."""
    parts = []
    for i, x in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(c(x).cast("string"))
    return F.concat(*parts)


def not_like_any(col, patterns) -> Column:
    """FLT3: UPPER(x) NOT LIKE p1 AND ... ; '_' stays a one-character wildcard."""
    u = F.upper(c(col))
    return reduce(lambda a, b: a & b, [~u.like(p) for p in patterns])


def band(x, edges, labels) -> Column:
    """SF27: ``when`` ladder; value <= edges[i] -> labels[i]; anything else (null too) -> labels[-1]."""
    x = c(x)
    expr = None
    for e, lab in zip(edges, labels):
        cond = x <= F.lit(e)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def in_window(df, start, end, col: str = "registered_date"):
    """SRC6: date-window filter; when the frame is month-partitioned (stored
    orders) the same window is applied to the partition column so the scan
    prunes whole months."""
    from pyspark.sql import functions as F
    cond = F.col(col).between(F.lit(start), F.lit(end))
    if "order_month" in df.columns:
        cond = cond & F.col("order_month").between(F.trunc(F.lit(start), "MM"), F.trunc(F.lit(end), "MM"))
    return df.filter(cond)


def since(df, start, col: str = "registered_date"):
    """SRC6 without an end: orders from ``start`` on, and only the months from then on."""
    from pyspark.sql import functions as F
    cond = F.col(col) >= F.lit(start)
    if "order_month" in df.columns:
        cond = cond & (F.col("order_month") >= F.trunc(F.lit(start), "MM"))
    return df.filter(cond)


def in_months(df, start, end=None):
    """Rows of a fact (discounts, wallet, funding, coupons) whose order lies in the months
    from ``start`` to ``end``. The stored facts are partitioned by the order's month, so
    the scan reads these months only; the join with the orders of the exact window
    follows. Facts without that column pass through."""
    from pyspark.sql import functions as F
    if "order_month" not in df.columns:
        return df
    cond = F.col("order_month") >= F.trunc(F.lit(start), "MM")
    if end is not None:
        cond = cond & (F.col("order_month") <= F.trunc(F.lit(end), "MM"))
    return df.filter(cond).drop("order_month")


def created_in(df, start, end=None):
    """Vouchers made from ``start`` on (until ``end``), by the day of ``created_at``. The stored
    creations are partitioned by that month, so the scan reads these months only."""
    day = F.to_date("created_at")
    cond = day >= F.lit(start)
    if end is not None:
        cond = cond & (day <= F.lit(end))
    if "created_month" not in df.columns:
        return df.filter(cond)
    cond = cond & (F.col("created_month") >= F.trunc(F.lit(start), "MM"))
    if end is not None:
        cond = cond & (F.col("created_month") <= F.trunc(F.lit(end), "MM"))
    return df.filter(cond).drop("created_month")


def local_day(ts, tz) -> Column:
    """SF21: the day of a UTC timestamp in a zone; without a zone, its UTC day."""
    return F.coalesce(F.to_date(local_time(ts, tz)), F.to_date(c(ts)))


def created_near(df, start, end=None):
    """Vouchers that any zone may count as made from ``start`` on (until ``end``): the UTC
    window a day wider on both sides, as zones lie 12 hours behind UTC to 14 ahead. It prunes
    like ``created_in``; ``made_on`` then decides by each row's own zone."""
    day = dt.timedelta(days=1)
    return created_in(df, start - day, None if end is None else end + day)


def made_on(start, end=None, ts="created_at", tz="timezone") -> Column:
    """FLT2: the row's local day lies in the window."""
    day = local_day(ts, tz)
    return day >= F.lit(start) if end is None else day.between(F.lit(start), F.lit(end))
