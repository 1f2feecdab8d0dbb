"""The daily batch (E1): run registered reports, write each one, keep a run log.

usage: python -m retentio.plans.daily OUT_DIR SF_DIR [--as-of YYYY-MM-DD] [--by-country KEY ...] [--csv] [--sheets DIR] [KEY ...]

Each report is written to OUT_DIR/<key>, sorted by its text and date columns
(Parquet or CSV, overwrite); the reports after ``--by-country`` get one folder per
country. A report that fails is logged as ``Error`` and the others still run. The
log is appended to OUT_DIR/_run_log in every case; the exit code is 1 if a report
failed. Output folders must be shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from ..sources import sinks
from ..sources.lookups import SHEETS
from .defaults import AS_OF, reporting_on
from .registry import REGISTRY, model_for


def run(spark, sf_dir: str, out_dir: str, keys=None, by_country=(), as_of: dt.date = AS_OF, csv: bool = False,
        sheets: str | None = None) -> sinks.RunLog:
    log = sinks.RunLog(as_of)
    m = model_for(spark, sf_dir)
    out_dir = out_dir.rstrip("/")
    try:
        for key in keys or sorted(REGISTRY):
            path = f"{out_dir}/{key}"
            try:
                with reporting_on(as_of, sheets):
                    df = REGISTRY[key](m)
                order = sinks.key_order(df)
                if key in by_country and "Country" in df.columns:
                    sinks.write_by_key(df, path, "Country", sort=order)
                elif csv:
                    sinks.write_csv(df, path, sort=order)
                else:
                    sinks.write_table(df, path, sort=order)
                log.record(key, "Correcto", sinks.written_rows(spark, path, "csv" if csv and key not in by_country else "parquet"))
            except Exception as e:  # logged; the batch goes on and fails at its end
                log.record(key, "Error", error=f"{type(e).__name__}: {e}"[:2000])
    finally:
        if log.rows:
            log.publish(spark, f"{out_dir}/_run_log")
    return log


def main(argv=None) -> int:
    from ..session import get_session
    ap = argparse.ArgumentParser(prog="retentio.plans.daily")
    ap.add_argument("out_dir")
    ap.add_argument("sf_dir")
    ap.add_argument("keys", nargs="*")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=AS_OF)
    ap.add_argument("--by-country", nargs="*", default=())
    ap.add_argument("--csv", action="store_true")
    ap.add_argument("--sheets", help="folder with " + ", ".join(SHEETS))
    a = ap.parse_args(argv)
    log = run(get_session(), a.sf_dir, a.out_dir, a.keys or None, a.by_country, a.as_of, a.csv, a.sheets)
    for r in log.rows:
        print(*r)
    return 1 if log.failed else 0


if __name__ == "__main__":
    sys.exit(main())
