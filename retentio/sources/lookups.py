"""Small reference sheets: rules, tax, lists, block list, competition zones.

SRC2 reads a sheet (CSV with a header row, every column a string) and fails
loudly. SRC3 turns the wide rule sheet (triplets ``Columna, Search, Value``
side by side) into long rules with a priority. SRC4 replaces a dict literal in
a cell by a two-column lookup frame.

The ``*_FIXTURE`` values below are the sheets the registered queries use. They
are repeated as ``VALUES`` in the oracle SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rule sheet, in sheet order (filter, search, value).
RULES_FIXTURE = [
    ("BENEFICIOS", "W_", "WALLET"),
    ("BENEFICIOS", "PROMO", "CASHBACK"),
    ("BENEFICIOS", "", "DISCOUNT"),
    ("TIPOS", "RED", "RMO"),
    ("TIPOS", "BLUE", "RAF"),
    ("TIPOS", "RED", "RMX"),
    ("TIPOS", "", "OTHER"),
    ("SEGMENTOS", "SMALL", "WELCOME"),
    ("SEGMENTOS", "LARGE", "15-30"),
    ("SEGMENTOS", "OLD", "180"),
    ("SEGMENTOS", "ZZZ", "NONE"),
    ("NIVELES", "BRAND1", "L1"),
    ("NIVELES", "BRAND2", "L2"),
    ("NIVELES", "ZZZ", "L0"),
    ("CAMPAIGNS", "ECONOMY", "ACQUISITION"),
    ("CAMPAIGNS", "STANDARD", "RETENTION"),
    ("CAMPAIGNS", "ZZZ", "OTHER"),
    ("AUTOMATIONS", "PROMO", "AUTO"),
    ("AUTOMATIONS", "ZZZ", "MANUAL"),
    ("BUDGET", "ECONOMY", "CENTRAL"),
    ("BUDGET", "MEDIUM", "LOCAL"),
    ("BUDGET", "W_", "CENTRAL"),
    ("BUDGET", "ZZZ", "NONE"),
    ("TRIAL", "GIZMO", "TRIAL"),
    ("TRIAL", "ZZZ", "NO TRIAL"),
]

# Tax sheet (Country, IVA, Extra) as strings; blank cells become 0.
TAX_FIXTURE = [
    ("Nation_0", "0.21", "1"),
    ("NATION_1", "0.19", ""),
    ("NATION_3", "0.22", "1"),
    ("NATION_4", "0.18", "0.5"),
    ("NATION_5", "0.16", "1"),
    ("NATION_7", "0.12", "1"),
    ("NATION_9", "0.07", "1"),
    ("NATION_10", "", "1"),
    ("NATIÓN_12", "0.10", "1"),
]

# The 'Paises' list, a name-normalising dict (accented -> plain).
COUNTRY_RENAME_FIXTURE = [("NATIÓN_12", "NATION_12")]

# Block list (campaign-name substrings, upper-cased on load).
BLOCK_FIXTURE = ["brand13_", "OLD_ANVIL"]

# Warehouse-side LIKE exclusions ('_' is a one-character wildcard).
EXCLUDE_LIKE_FIXTURE = ["%BRAND2_%", "%_GIZMO"]

# Competition zones (Country, Tipo, Union, Competencia).
ZONES_FIXTURE = [
    ("NATION_0", "CITY", "NATION_0-BUILDING-", "HIGH"),
    ("NATION_0", "CITY", "NATION_0-MACHINERY-", "MEDIUM"),
    ("NATION_1", "CITY-AREA", "NATION_1-HOUSEHOLD-AREA_3", "HIGH"),
    ("NATION_1", "CITY-AREA", "NATION_1-AUTOMOBILE-AREA_5", "MEDIUM"),
    ("NATION_2", "CITY", "NATION_2-FURNITURE-", "HIGH"),
    # the key format of the competition board
    ("NATION_1", "CITY-AREA", "HOUSEHOLD-AREA_3", "HIGH"),
    ("NATION_1", "CITY-AREA", "AUTOMOBILE-AREA_5", "MEDIUM"),
    ("NATION_0", "CITY", "-AREA_2", "LOW"),
]


# City competition sheet (City_Final, Competencia); the big city is split by area.
CITY_COMPETITION_FIXTURE = [
    ("MACHINERY", "ALTA"),
    ("FURNITURE", "MEDIA"),
    ("AREA_3", "ALTA"),
    ("AREA_7", "BAJA"),
]
BIG_CITY = "BUILDING"


def read_sheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """SRC2: a small sheet exported as CSV; every column is a string. Fails loudly."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def wide_rules_to_long(wide: DataFrame) -> DataFrame:
    """SRC3: triplet column groups stacked into (filter, search, value, priority).

    Blank columns are dropped and blank rows skipped. Priority is the position
    in the sheet: group by group, then row by row (the rule order the
    classification uses). A ``row`` column gives the row's position, as in the
    sheets of ``load_sheets``; a frame without one is taken in the order of its
    partitions, which is right for local rows only.
    """
    cols = [c for c in wide.columns if c.strip() != "" and c != "row"]
    position = F.col("row").cast("long") if "row" in wide.columns else F.monotonically_increasing_id()
    indexed = wide.select(*cols, position.alias("row_idx"))
    groups = []
    for g in range(len(cols) // 3):
        a, b, v = cols[g * 3:g * 3 + 3]
        groups.append(indexed.select(
            F.col(a).alias("filter"), F.coalesce(F.col(b), F.lit("")).alias("search"),
            F.col(v).alias("value"), F.lit(g).alias("grp"), "row_idx"))
    long = reduce(lambda x, y: x.unionByName(y), groups).filter(F.coalesce(F.col("filter"), F.lit("")) != "")
    return long.select("filter", "search", "value",
                       (F.col("grp") * F.lit(1 << 40) + F.col("row_idx")).alias("priority"))


#: The sheets of a folder: file name -> columns.
SHEETS = {
    "rules.csv": ["row", "filter", "search", "value"],
    "tax.csv": ["Country", "IVA", "Extra"],
    "rename.csv": ["src", "dst"],
    "zones.csv": ["Country", "Tipo", "Union", "Competencia"],
    "block.csv": ["token"],
}
#: Tokens of a block list that are taken into a filter expression, at most.
MAX_BLOCK = 10_000


def load_sheets(spark: SparkSession, folder: str | None = None) -> dict:
    """Rules, tax, rename, zones and block list, from CSV files (SRC2, SRC3) or, without
    a folder, the fixed ones."""
    if not folder:
        return {"rules": rules_frame(spark), "tax": tax_frame(spark), "rename": rename_frame(spark), "zones": zones_frame(spark),
                "block": block_list()}
    frames = {name.split(".")[0]: read_sheet(spark, f"{folder.rstrip('/')}/{name}", cols) for name, cols in SHEETS.items()}
    tokens = frames.pop("block").limit(MAX_BLOCK + 1).collect()
    if len(tokens) > MAX_BLOCK:
        raise ValueError(f"the block list has more than {MAX_BLOCK} tokens")
    frames["rules"] = wide_rules_to_long(frames["rules"])
    frames["tax"] = frames["tax"].fillna("", ["IVA", "Extra"])
    return frames | {"block": block_list([r.token for r in tokens if r.token])}


def rules_frame(spark: SparkSession, rules=RULES_FIXTURE) -> DataFrame:
    rows = [(f, s, v, i) for i, (f, s, v) in enumerate(rules)]
    return spark.createDataFrame(rows, "filter string, search string, value string, priority long")


def tax_frame(spark: SparkSession, tax=TAX_FIXTURE) -> DataFrame:
    return spark.createDataFrame(list(tax), "Country string, IVA string, Extra string")


def rename_frame(spark: SparkSession, pairs=COUNTRY_RENAME_FIXTURE) -> DataFrame:
    """SRC4: the dict literal as a two-column lookup."""
    return spark.createDataFrame(list(pairs), "src string, dst string")


def zones_frame(spark: SparkSession, zones=ZONES_FIXTURE) -> DataFrame:
    return spark.createDataFrame(list(zones), "Country string, Tipo string, Union string, Competencia string")


def block_list(tokens=BLOCK_FIXTURE) -> list[str]:
    """U2 sheet: tokens upper-cased on load."""
    return [t.upper() for t in tokens]


def city_competition_frame(spark: SparkSession, rows=CITY_COMPETITION_FIXTURE) -> DataFrame:
    return spark.createDataFrame(list(rows), "City_Final string, Competencia string")
