"""The user state: extending it month by month equals computing it anew, and reports read only it and their months."""

import datetime as dt
import re
import tempfile

import pytest

from retentio.operators import history, lifecycle
from retentio.sources.adapter import StoredModel
from retentio.sources.tables import load_tables

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 7, 15)


@pytest.fixture(scope="module")
def model(spark):
    return StoredModel(load_tables(spark, SF), tempfile.mkdtemp(prefix="/tmp/retentio-state-"))


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_extended_month_by_month_equals_the_whole_history(model):
    orders = model.orders()
    state = history.full_state(orders, dt.date(2001, 2, 28))
    for month in (3, 4, 5, 6):
        state = history.extended(state, orders, dt.date(2001, month, 1))
    assert rows(state) == rows(history.full_state(orders, dt.date(2001, 6, 30)))


def test_the_stored_state_is_extended_from_the_month_before(model):
    model.user_state(dt.date(2001, 5, 31))
    got = model.user_state(dt.date(2001, 6, 30))
    assert rows(got) == rows(history.full_state(model.orders(), dt.date(2001, 6, 30)))


def test_an_empty_month_leaves_the_state_as_it_is(model):
    state = history.full_state(model.orders(), dt.date(2001, 8, 31))
    assert rows(history.extended(state, model.orders(), dt.date(2001, 9, 1))) == rows(state)


@pytest.mark.parametrize("report", ["vertical_trials", "reactivations", "reactivation_profile", "vertical_trials_by_campaign"])
def test_reports_scan_the_state_and_their_months(model, report):
    df = {"vertical_trials": lambda: lifecycle.vertical_trials(model, AS_OF, dt.date(2001, 7, 1), dt.date(2001, 7, 31)),
          "reactivations": lambda: lifecycle.reactivations(model, AS_OF), "reactivation_profile": lambda: lifecycle.reactivation_profile(model, AS_OF),
          "vertical_trials_by_campaign": lambda: lifecycle.vertical_trials_by_campaign(model, AS_OF, [dt.date(2001, 7, 1), dt.date(2001, 6, 1)])}[report]()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert any("user_state" in s for s in scans)
    facts = [s for s in scans if re.search(r"Location:[^,]*\[[^\]]*/(orders|coupons)[\],/]", s) or "order_month" in s]
    assert facts and all("order_month" in s.split("PartitionFilters:")[1].split("PushedFilters")[0] for s in facts)
