"""Fixed parameters of the registered queries.

The test orders run 1995-01-01 .. 2001-08-01, so "today" for the registered
queries is a fixed date inside the data. Operators take it as an argument;
nothing reads the wall clock.
"""

import contextlib
import contextvars
import datetime as dt

AS_OF = dt.date(2001, 7, 15)
# Few users are new at the end of the data: reports on first orders and first trials run on a day
# of the first year.
EARLY = dt.date(1995, 7, 15)

_sheets_in = contextvars.ContextVar("sheets", default=None)
_today = contextvars.ContextVar("today", default=None)


def today(default: dt.date = AS_OF) -> dt.date:
    """The day that the reports being planned report on; ``default`` unless a batch set one."""
    return _today.get() or default


def sheets_folder() -> str | None:
    """The folder that the rule, tax, zone and block sheets are read from, if any."""
    return _sheets_in.get()


@contextlib.contextmanager
def reporting_on(day: dt.date, sheets: str | None = None):
    """Plan reports for another day than ``AS_OF``, with the sheets of a folder."""
    tokens = _today.set(day), _sheets_in.set(sheets)
    try:
        yield
    finally:
        _today.reset(tokens[0])
        _sheets_in.reset(tokens[1])


# The event table covers 2024-01-01 .. 2024-01-30; its queries run over that window.
EVENTS_START = dt.date(2024, 1, 1)
EVENTS_END = dt.date(2024, 1, 31)
