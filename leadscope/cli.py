"""Command line: ``python -m leadscope.cli etl|report ...``.

``etl`` runs one ETL pass over landed task pages (flags as in the original
batch job: ``--force-refresh``, ``--validation-only``, ``--days-back``).
``report`` writes one registered report as Parquet or CSV.
"""

from __future__ import annotations

import argparse
import datetime as dt
import time


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="leadscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    e.add_argument("--landing", required=True)
    e.add_argument("--root", required=True, help="table root on shared storage")
    e.add_argument("--as-of", default=dt.date.today().isoformat())
    e.add_argument("--days-back", type=int, default=30)
    e.add_argument("--force-refresh", action="store_true")
    e.add_argument("--validation-only", action="store_true")
    e.add_argument("--backup")
    r = sub.add_parser("report")
    r.add_argument("key", help="query key, e.g. vw01_source_quality")
    r.add_argument("--sf-dir", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    a = ap.parse_args(argv)

    from .session import build_session
    spark = build_session(app=f"leadscope-{a.cmd}")
    if a.cmd == "etl":
        from .plans.etl import run_etl
        counters = run_etl(spark, a.landing, a.root, int(time.time()), a.as_of, a.days_back,
                           a.force_refresh, a.validation_only, backup=a.backup)
        counters.show(truncate=False)
    else:
        from .catalog import queries
        df = queries()[a.key](spark, a.sf_dir)
        w = df.write.mode("errorifexists")
        (w.option("header", True).csv(a.out) if a.format == "csv" else w.parquet(a.out))
    spark.stop()


if __name__ == "__main__":
    main()
