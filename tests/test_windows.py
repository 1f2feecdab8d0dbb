import calendar
import datetime as dt

from retentio.functions import windows as W


def test_month_windows_regular_and_day_one():
    mw = W.month_windows(dt.date(2021, 3, 15))
    assert mw == (dt.date(2021, 3, 1), dt.date(2021, 3, 31), dt.date(2021, 2, 1), dt.date(2021, 2, 28))
    mw1 = W.month_windows(dt.date(2021, 3, 1))  # day 1 reports the previous full month
    assert mw1 == (dt.date(2021, 2, 1), dt.date(2021, 2, 28), dt.date(2021, 1, 1), dt.date(2021, 1, 31))
    jan = W.month_windows(dt.date(2021, 1, 1))
    assert jan.itm == dt.date(2020, 12, 1) and jan.ilm == dt.date(2020, 11, 1)


def test_add_months_clips_to_month_end():  # T25
    assert W.add_months(dt.date(2021, 3, 31), -1) == dt.date(2021, 2, 28)
    assert W.add_months(dt.date(2020, 3, 31), -1) == dt.date(2020, 2, 29)
    assert W.add_months(dt.date(2021, 1, 31), 13) == dt.date(2022, 2, 28)


def test_three_and_n_month_windows():
    assert W.three_month_window(dt.date(2021, 7, 15)) == (dt.date(2021, 5, 1), dt.date(2021, 7, 31))
    assert W.three_month_window(dt.date(2021, 7, 1)) == (dt.date(2021, 4, 1), dt.date(2021, 6, 30))
    assert W.n_month_start(dt.date(2021, 7, 15), 13) == dt.date(2020, 7, 1)
    assert W.n_month_start(dt.date(2021, 7, 1), 13) == dt.date(2020, 6, 1)


def test_last_complete_week():
    assert W.last_complete_week(dt.date(2021, 7, 18)) == (dt.date(2021, 7, 12), dt.date(2021, 7, 18))  # Sunday
    assert W.last_complete_week(dt.date(2021, 7, 19)) == (dt.date(2021, 7, 12), dt.date(2021, 7, 18))  # Monday


def _rr_brute(d, w=1.4):
    weights = {4: w, 5: w, 6: w}
    days = calendar.monthrange(d.year, d.month)[1]
    total = sum(weights.get(dt.date(d.year, d.month, i).weekday(), 1.0) for i in range(1, days + 1))
    done = sum(weights.get(dt.date(d.year, d.month, i).weekday(), 1.0) for i in range(1, d.day))
    return done / total


def test_run_rate():
    assert W.run_rate(dt.date(2021, 7, 1)) == 1.0
    for day in (2, 15, 31):
        d = dt.date(2021, 7, day)
        assert abs(W.run_rate(d) - _rr_brute(d)) < 1e-12


def test_run_rate_frame_matches_scalar(spark):
    from retentio.operators.boards import run_rate_frame
    for d in (dt.date(2021, 7, 1), dt.date(2021, 7, 15), dt.date(2021, 2, 28)):
        assert run_rate_frame(spark, d).collect()[0]["rr"] == W.run_rate(d)
