import random

import pytest

from retentio.functions import rules as R
from retentio.operators import matcher
from retentio.sources import lookups as L

SHEET = [("TIPOS", "RED", "RMO"), ("TIPOS", "BLUE_SKY", "RAF"), ("TIPOS", "RED", "RMX"), ("TIPOS", "%", "PCT"), ("TIPOS", "GREEN", "GRN"),
         ("SEGMENTOS", "SMALL", "WELCOME"), ("SEGMENTOS", "", "ALL"), ("SEGMENTOS", "RED", "NEVER"),
         ("BENEFICIOS", None, "ANY"), ("NIVELES", "ñ", None), ("NIVELES", "z", "Z")]
NAMES = ["RED", "XREDX", "BLUE_SKY RED", "BLUE_SK", "100%", "", None, "small", "SMALL RED", "GREEN", "año", "None", "z" * 300, "REDRED", "RED"]
FILTERS = ["TIPOS", "SEGMENTOS", "BENEFICIOS", "NIVELES", "NOPE"]


def _sheet(spark, rows):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "filter string, search string, value string, priority long")


def _both(spark, names, rows, benefit=None):
    df = spark.createDataFrame([(k, n, "WALLET" if k % 3 == 0 else None) for k, n in enumerate(names)], "k long, name string, benefit string")
    want = R.classify_campaigns(df, "name", R.compile_rules(rows), FILTERS, benefit)
    got = matcher.attach_classes(df, "name", _sheet(spark, rows), FILTERS, benefit)
    assert got.columns == want.columns
    return sorted(map(tuple, got.collect()), key=lambda r: r[0]), sorted(map(tuple, want.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("benefit", [None, "benefit"])
def test_same_classes_as_the_compiled_sheet(spark, benefit):
    got, want = _both(spark, NAMES, SHEET, benefit)
    assert got == want


def test_random_sheets(spark):
    rng = random.Random(3)
    text = lambda a, b: "".join(rng.choices("ab_", k=rng.randint(a, b)))
    rows = [(rng.choice(FILTERS[:4]), text(0 if k == 60 else 1, 7), f"v{k}") for k in range(120)]
    got, want = _both(spark, [text(0, 25) for _ in range(300)], rows)
    assert got == want


def test_fifty_thousand_rules(spark):
    rows = [("TIPOS", f"CODE_{k:05d}", f"T{k}") for k in range(50_000)]
    df = spark.range(2_000).selectExpr("concat('brand_CODE_', lpad(string(id * 25), 5, '0'), '_x') AS name", "id")
    out = matcher.attach_classes(df, "name", _sheet(spark, rows), ["TIPOS"])
    assert all(r["Type"] == f"T{r['id'] * 25}" for r in out.collect())
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_block_list_of_any_length(spark):
    df = spark.createDataFrame([(k, n) for k, n in enumerate(NAMES)], "k long, name string")
    for tokens in (["RED", "ñ", "zzzzz"], ["", "RED"], []):
        frame = spark.createDataFrame([(t,) for t in tokens], "token string")
        want = sorted(r.k for r in R.drop_blocked(df, "name", tokens).collect())
        assert sorted(r.k for r in matcher.drop_blocked_names(df, "name", frame).collect()) == want


def test_empty_tables_and_the_given_sheet(spark):
    df = spark.createDataFrame([("BRAND1",)], "name string")
    sheet = L.rules_frame(spark)
    assert matcher.attach_classes(df.limit(0), "name", sheet).collect() == []
    want = R.classify_campaigns(df, "name", R.rules_from_frame(sheet)).collect()
    assert matcher.attach_classes(df, "name", sheet).collect() == want
    assert set(matcher.attach_classes(df, "name", sheet.limit(0)).first()[1:]) == {R.UNKNOWN_FILTER}
