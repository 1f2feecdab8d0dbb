import csv
import tempfile

import pytest

from retentio.functions import rules as R
from retentio.plans import daily
from retentio.plans.registry import REGISTRY, model_for
from retentio.sources import lookups as L

SF = "/root/testdata/sf0.001"


def _write(folder, name, rows):
    with open(f"{folder}/{name}", "w", newline="") as f:
        csv.writer(f).writerows([L.SHEETS[name], *rows])


@pytest.fixture
def folder():
    out = tempfile.mkdtemp(prefix="/tmp/retentio-sheets-")
    _write(out, "rules.csv", [(i, *r) for i, r in enumerate(L.RULES_FIXTURE)])
    _write(out, "tax.csv", L.TAX_FIXTURE)
    _write(out, "rename.csv", L.COUNTRY_RENAME_FIXTURE)
    _write(out, "zones.csv", L.ZONES_FIXTURE)
    _write(out, "block.csv", [(t,) for t in L.BLOCK_FIXTURE])
    return out


def test_sheets_from_a_folder_equal_the_fixed_ones(spark, folder):
    own, fixed = L.load_sheets(spark, folder), L.load_sheets(spark)
    assert R.rules_from_frame(own["rules"]) == R.compile_rules(L.RULES_FIXTURE) == R.rules_from_frame(fixed["rules"])
    assert own["block"] == fixed["block"]
    for name in ("zones", "rename"):
        assert sorted(own[name].collect()) == sorted(fixed[name].collect())
    tax = lambda s: sorted(R.prepare_tax(s["tax"], s["rename"]).collect())
    assert tax(own) == tax(fixed)


def test_the_batch_uses_them(spark, folder):
    _write(folder, "tax.csv", [("NATION_0", "1.0", "1")])
    out = tempfile.mkdtemp(prefix="/tmp/retentio-daily-")
    daily.run(spark, SF, out, keys=["country_net_spend"], sheets=folder)
    mine = {r.Country: r.IVA for r in spark.read.parquet(f"{out}/country_net_spend").collect()}
    usual = {r.Country: r.IVA for r in REGISTRY["country_net_spend"](model_for(spark, SF)).collect()}
    assert set(mine.values()) <= {0.0, 1.0} and set(usual.values()) - {0.0, 1.0}


def test_a_repeated_zone_is_refused(spark):
    with pytest.raises(ValueError):
        R.prepare_zones(L.zones_frame(spark, [("A", "CITY", "A-x-", "HIGH"), ("A", "CITY", "A-x-", "LOW")]))


def test_a_rule_sheet_keeps_its_order(spark):
    wide = spark.createDataFrame([(i, "TIPOS", f"S{i}", f"V{i}") for i in range(9)], "row int, filter string, search string, value string")
    long = L.wide_rules_to_long(wide.repartition(4))
    assert [r.search for r in long.orderBy("priority").collect()] == [f"S{i}" for i in range(9)]
