"""Rule-sheet classification, block list, tax and name normalisation.

The sheets are small configuration (tens of rows, bound-checked on load), so
they are compiled into column expressions: a ``CASE`` ladder for the rules
and an ``OR`` of substring tests for the block list. Data never leaves the
executors; no Python UDF is involved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.guards import bounded_broadcast

MAX_RULES = 10_000

# filter name -> output column
FILTER_COLUMNS = {
    "BENEFICIOS": "Benefit",
    "TIPOS": "Type",
    "SEGMENTOS": "Segment",
    "NIVELES": "Level",
    "CAMPAIGNS": "Campaña",
    "AUTOMATIONS": "Automated",
    "BUDGET": "Budget",
    "TRIAL": "Trial",
}
UNKNOWN_FILTER = "No Existe Filtro"


def compile_rules(rows) -> dict[str, list[tuple[str, str]]]:
    """Rows ``(filter, search, value)`` in priority order -> ordered rules per filter.

    A repeated search keeps its first position and takes the last value (the
    sheet is loaded into a dict keyed by search).
    """
    out: dict[str, dict[str, str]] = {}
    for f, s, v in rows:
        out.setdefault(f, {})[s if s is not None else ""] = v
    return {f: list(d.items()) for f, d in out.items()}


def rules_from_frame(df: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """Load a long rule frame (filter, search, value, priority); bounded, then compiled."""
    rows = df.orderBy("priority").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"rule sheet has more than {MAX_RULES} rows: use operators.matcher.attach_classes")
    return compile_rules([(r["filter"], r["search"], r["value"]) for r in rows])


def classify(name, filter_name: str, rules: dict, benefit=None) -> Column:
    """First rule whose search is a substring of the name wins; no match -> last rule's value.

    A null name is compared as the text 'None'. ``benefit == 'WALLET'`` forces
    'WALLET'. An unknown filter gives 'No Existe Filtro'.
    """
    if filter_name not in rules or not rules[filter_name]:
        return F.lit(UNKNOWN_FILTER)
    name = F.coalesce((F.col(name) if isinstance(name, str) else name).cast("string"), F.lit("None"))
    items = rules[filter_name]
    expr = None
    for search, value in items:
        cond = F.lit(True) if search == "" else name.contains(search)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    expr = expr.otherwise(F.lit(items[-1][1]))
    if benefit is not None:
        b = F.col(benefit) if isinstance(benefit, str) else benefit
        expr = F.when(F.coalesce(b == "WALLET", F.lit(False)), F.lit("WALLET")).otherwise(expr)
    return expr


def classify_campaigns(df: DataFrame, name_col: str, rules: dict, filters=None,
                       benefit_col: str | None = None, override_filters=("TIPOS",)) -> DataFrame:
    """Add one column per filter (Benefit, Type, Segment, ...)."""
    filters = filters or list(FILTER_COLUMNS)
    cols = {}
    for f in filters:
        b = benefit_col if (benefit_col and f in override_filters) else None
        cols[FILTER_COLUMNS.get(f, f)] = classify(name_col, f, rules, b)
    return df.withColumns(cols)


def blocked(name, tokens) -> Column:
    """U2: 'Si' when any block token is a substring of the name, else 'No' (null name -> 'No')."""
    name = F.col(name) if isinstance(name, str) else name
    if not tokens:
        return F.lit("No")
    hit = reduce(lambda a, b: a | b, [name.contains(t) for t in tokens])
    return F.when(F.coalesce(hit, F.lit(False)), F.lit("Si")).otherwise(F.lit("No"))


def drop_blocked(df: DataFrame, name_col: str, tokens) -> DataFrame:
    """FLT10: keep rows whose campaign is not blocked."""
    return df.filter(blocked(name_col, tokens) == "No")


def prepare_tax(tax: DataFrame, rename: DataFrame | None = None) -> DataFrame:
    """Tax sheet -> (Country, IVA, Extra) doubles. Blank cells are 0 (T14);
    countries upper-cased, then renamed through the 'Paises' dict (U4);
    duplicate countries are rejected (T15)."""
    t = tax.select(F.upper("Country").alias("Country"),
                   F.when(F.trim("IVA") == "", "0").otherwise(F.col("IVA")).cast("double").alias("IVA"),
                   F.when(F.trim("Extra") == "", "0").otherwise(F.col("Extra")).cast("double").alias("Extra"))
    if rename is not None:
        r = bounded_broadcast(rename.select(F.col("src").alias("_src"), F.col("dst").alias("_dst")))
        t = (t.join(r, t.Country == r._src, "left")
             .select(F.coalesce("_dst", "Country").alias("Country"), "IVA", "Extra"))
    dup = t.groupBy("Country").count().filter("count > 1").limit(1).count()
    if dup:
        raise ValueError("tax sheet has a repeated country")
    return t


def prepare_zones(zones: DataFrame) -> DataFrame:
    """Zone sheet with each key once: a repeated key would count its spend twice."""
    if zones.groupBy("Union").count().filter("count > 1").limit(1).count():
        raise ValueError("zone sheet has a repeated key")
    return zones


def attach_tax(df: DataFrame, tax: DataFrame) -> DataFrame:
    """upper(Country) and the country's IVA / Extra (missing -> 0 / 1).

    The tax frame is joined as given: callers pass it through
    ``guards.broadcast_if_small`` once (one row per country), so the join is
    a broadcast only when its size has been checked.
    """
    j = df.withColumn("Country", F.upper("Country")).join(tax, "Country", "left")
    return j.withColumn("IVA", F.coalesce("IVA", F.lit(0.0))).withColumn("Extra", F.coalesce("Extra", F.lit(1.0)))


def net_of_tax(df: DataFrame, tax: DataFrame, shopper_col: str, other_col: str,
               out: str = "Final") -> DataFrame:
    """U3 + D16: attach IVA/Extra by upper(Country) and net the shopper-paid part.

    Missing country -> IVA 0, Extra 1. ``out = shopper / (1 + IVA) * Extra + other``.
    """
    j = attach_tax(df, tax)
    return j.withColumn(out, F.col(shopper_col) / (F.lit(1.0) + F.col("IVA")) * F.col("Extra") + F.col(other_col))
