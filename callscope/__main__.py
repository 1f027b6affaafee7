"""The daily job, e.g. ``python -m callscope RAW_DIR OUT_DIR --as-of 2024-01-31T06:00``."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from callscope.plans.daily import run_daily


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_dir")
    parser.add_argument("out_dir")
    parser.add_argument("--as-of", type=datetime.fromisoformat, required=True, help="naive UTC")
    parser.add_argument("--fx-payload", help="landed JSON answer of the rate provider")
    parser.add_argument("--fx-rule", choices=["latest", "nearest"], default="latest")
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--max-blank-notes", type=float, help="share of blank notes that fails the run")
    parser.add_argument("--provider", action="append", help="known payment provider; others fail the run")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("callscope").getOrCreate()
    report = run_daily(
        spark,
        args.raw_dir,
        args.out_dir,
        args.as_of,
        full_refresh=args.full_refresh,
        fx_payload=args.fx_payload,
        fx_rule=args.fx_rule,
        max_blank_notes=args.max_blank_notes,
        providers=args.provider,
    )
    for landed in report.landed:
        print(f"landed {landed.table}: files {landed.files}, rows {landed.rows}")
    for table, rows in report.rows.items():
        print(f"wrote {table}: rows {rows}")


if __name__ == "__main__":
    main()
