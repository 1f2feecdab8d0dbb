"""Rule sheets and block lists of any length, matched to distinct names by a gram index.

``functions.rules`` compiles a sheet of a bounded number of rules into one CASE per
filter. Here the sheet stays a table. A search string is entered once, under that of its
grams (substrings of ``GRAM`` characters) that the fewest searches hold; a shorter one
under itself. A name can hold a search only if it holds that gram, so names and rules
join on grams and only those candidates are compared. Names are made distinct first, and
the class is joined back: a campaign is matched once, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import FILTER_COLUMNS, UNKNOWN_FILTER
from ..plans.guards import broadcast_if_small

GRAM = 4
#: A null name is compared as this text.
NULL_NAME = "None"


def ordered_rules(rules: DataFrame) -> DataFrame:
    """(filter, search, value, pos) of a sheet (filter, search, value, priority): a repeated
    search keeps its first position and takes its last value; a null search is empty."""
    rules = rules.select("filter", F.coalesce("search", F.lit("")).alias("search"), "value", "priority")
    last = F.max(F.struct("priority", "value"))["value"]  # priorities are unique
    return rules.groupBy("filter", "search").agg(F.min("priority").alias("pos"), last.alias("value"))


def _grams(text: Column, size: Column) -> Column:
    """The distinct substrings of ``size`` characters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size)))


def _indexed(searches: DataFrame) -> DataFrame:
    """(search, gram): each search that is not empty under one gram."""
    size = F.least(F.length("search"), F.lit(GRAM))
    grams = searches.where("search != ''").select("search", F.explode(_grams(F.col("search"), size)).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("n"))
    return grams.join(counts, "gram").groupBy("search").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))


def matches(names: DataFrame, searches: DataFrame) -> DataFrame:
    """(name, search) for every distinct name that holds a distinct search (not empty)."""
    index = _indexed(searches.select("search").distinct())
    names = names.select("name").where("name is not null").distinct()
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.length("name"), F.lit(GRAM)))).alias("size")
    grams = (names.where("name != ''").select("name", sizes)
             .select("name", F.explode(_grams(F.col("name"), F.col("size"))).alias("gram")))
    return grams.join(index, "gram").where(F.col("name").contains(F.col("search"))).select("name", "search")


def attach_classes(df: DataFrame, name_col: str, rules: DataFrame, filters=None,
                   benefit_col: str | None = None, override_filters=("TIPOS",)) -> DataFrame:
    """U1 and D15 for a sheet (filter, search, value, priority) of any length: the columns
    of ``rules.classify_campaigns``.

    The first rule whose search the name holds wins; an empty search is held by every
    name; a name without a match takes the value of the filter's last rule.
    """
    filters = list(filters or FILTER_COLUMNS)
    rules = ordered_rules(rules.where(F.col("filter").isin(*filters)))
    rule = F.struct("pos", "value")
    ends = {r["filter"]: r for r in rules.groupBy("filter").agg(
        F.max(rule).alias("last"), F.min(F.when(F.col("search") == "", rule)).alias("always")).collect()}  # a row per filter

    named = df.withColumn("_name", F.coalesce(F.col(name_col).cast("string"), F.lit(NULL_NAME)))
    found = matches(named.select(F.col("_name").alias("name")), rules).join(rules, "search")
    first = [F.min(F.when(F.col("filter") == f, rule)).alias(f"_c{k}") for k, f in enumerate(filters)]
    found = found.groupBy(F.col("name").alias("_name")).agg(*first)
    out = named.join(broadcast_if_small(found), "_name", "left")

    cols = {}
    for k, f in enumerate(filters):
        if f not in ends:
            cols[FILTER_COLUMNS.get(f, f)] = F.lit(UNKNOWN_FILTER)
            continue
        best, always = F.col(f"_c{k}"), ends[f]["always"]
        if always:  # the earlier position wins
            best = F.least(best, F.struct(F.lit(always["pos"]).cast("long").alias("pos"), F.lit(always["value"]).cast("string").alias("value")))
        value = F.when(best.isNull(), F.lit(ends[f]["last"]["value"]).cast("string")).otherwise(best["value"])
        if benefit_col and f in override_filters:
            value = F.when(F.col(benefit_col) == "WALLET", F.lit("WALLET")).otherwise(value)
        cols[FILTER_COLUMNS.get(f, f)] = value
    return out.withColumns(cols).drop("_name", *[f"_c{k}" for k in range(len(filters))])


def drop_blocked_names(df: DataFrame, name_col: str, tokens: DataFrame) -> DataFrame:
    """FLT10 for a block list (column token) of any length: rows whose name holds no token.
    A null name is kept; an empty token blocks every other name."""
    names = df.select(F.col(name_col).cast("string").alias("name")).where("name is not null").distinct()
    searches = tokens.select(F.col("token").alias("search"))
    bad = matches(names, searches).select("name")
    if searches.where("search = ''").limit(1).count():
        bad = names
    bad = broadcast_if_small(bad.select(F.col("name").alias("_name")).distinct())
    return df.join(bad, F.col(name_col).cast("string") == F.col("_name"), "left_anti")
