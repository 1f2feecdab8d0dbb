import pytest
from pyspark.sql import functions as F

from retentio.functions import rules as R
from retentio.sources import lookups as L

RULES = [("TIPOS", "RED", "RMO"), ("TIPOS", "BLUE", "RAF"), ("TIPOS", "RED", "RMX"), ("TIPOS", "GREEN", "GRN"),
         ("SEGMENTOS", "SMALL", "WELCOME"), ("SEGMENTOS", "ZZZ", "NONE"),
         ("BENEFICIOS", "", "ALL")]


def _classify(spark, names, filt, benefit=None):
    rules = R.compile_rules(RULES)
    df = spark.createDataFrame([(n, benefit) for n in names], "name string, benefit string")
    return [r[0] for r in df.select(R.classify("name", filt, rules, "benefit" if benefit else None)).collect()]


def test_repeated_search_keeps_first_position_last_value(spark):  # T16
    assert R.compile_rules(RULES)["TIPOS"][0] == ("RED", "RMX")
    assert _classify(spark, ["RED_BLUE"], "TIPOS") == ["RMX"]


def test_no_match_takes_last_rule_and_empty_search_matches_all(spark):
    assert _classify(spark, ["PURPLE"], "TIPOS") == ["GRN"]
    assert _classify(spark, ["anything"], "BENEFICIOS") == ["ALL"]


def test_unknown_filter_wallet_override_and_null_name(spark):  # U1, T5
    assert _classify(spark, ["RED"], "NOPE") == ["No Existe Filtro"]
    assert _classify(spark, ["RED"], "TIPOS", benefit="WALLET") == ["WALLET"]
    assert _classify(spark, [None], "TIPOS") == ["GRN"]   # compared as the text 'None'


def test_block_list(spark):  # U2
    df = spark.createDataFrame([("X_BRAND13_Y",), ("OK",), (None,)], "c string")
    got = [r[0] for r in df.select(R.blocked("c", L.block_list())).collect()]
    assert got == ["Si", "No", "No"]


def test_tax_blank_vs_missing(spark):  # T14, U3, U4
    tax = R.prepare_tax(L.tax_frame(spark), L.rename_frame(spark))
    df = spark.createDataFrame([("nation_1", 100.0, 10.0), ("NATION_2", 100.0, 10.0), ("NATION_12", 0.0, 0.0)],
                               "Country string, Amount_Shopper double, Amount double")
    out = {r["Country"]: r for r in R.net_of_tax(df, tax, "Amount_Shopper", "Amount").collect()}
    assert out["NATION_1"]["Extra"] == 0.0 and out["NATION_1"]["Final"] == 10.0      # blank Extra -> 0
    assert out["NATION_2"]["Extra"] == 1.0 and out["NATION_2"]["IVA"] == 0.0         # missing country -> 0 / 1
    assert out["NATION_12"]["IVA"] == 0.10                                           # renamed through the dict


def test_duplicate_tax_country_rejected(spark):  # T15
    with pytest.raises(ValueError):
        R.prepare_tax(L.tax_frame(spark, [("A", "0.1", "1"), ("a", "0.2", "1")]))


def test_wide_rule_sheet_to_long(spark):  # SRC3
    wide = spark.createDataFrame([("TIPOS", "RED", "RMO", "", "SEGMENTOS", "SMALL", "W"),
                                  ("TIPOS", "BLUE", "RAF", "", "", "", "")],
                                 "Columna string, Search string, Value string, ` ` string, Columna2 string, Search2 string, Value2 string")
    long = L.wide_rules_to_long(wide.drop(" "))
    rules = R.rules_from_frame(long)
    assert rules == {"TIPOS": [("RED", "RMO"), ("BLUE", "RAF")], "SEGMENTOS": [("SMALL", "W")]}
