"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once to warm up
and is then timed over its whole result. Whole runs of the job are timed cold. The same
rows from DuckDB, the reference's local engine, are timed beside it.
"""

from __future__ import annotations

import glob
import json
import os
import re
import time

import duckdb

from callscope.queries import ORACLES, QUERIES
from callscope.queries.refresh import forget_runs
from callscope.session import local_session

HEADLINE = (
    "m1_coding_rate",
    "m2_paid_post_call",
    "m3_value_recovered_usd",
    "m4_inbound_call_drivers",
    "int_calls_coded",
    "int_calls_payment_attribution",
    "payment_attribution_split_contracts",
    "k1_coding_rate_overall",
    "k2_paid_post_call_overall",
    "k3_value_recovered_by_market",
    "k4_top_inbound_drivers",
    "a10_driver_drill_down",
    "g2_note_classes",
    "g8_contract_load",
    "g9_value_at_nearest_rate",
    "s1_landed_calls",
)
#: Whole runs of the job: each is timed once, with nothing kept from another.
RUNS = ("i_daily_paid_post_call", "r1_full_build_paid_post_call", "t2_streamed_paid_post_call")


def timed(run) -> float:
    run()
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    con = duckdb.connect()
    con.execute(f"SET threads = {cpus if cpus.isdigit() else 8}")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")

    def spark_run(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def duck_run(name: str):
        return lambda: con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {ORACLES[name]}")

    seconds = {name: timed(spark_run(name)) for name in HEADLINE}
    for name in RUNS:
        forget_runs()
        start = time.perf_counter()
        spark_run(name)()
        seconds[name] = round(time.perf_counter() - start, 3)
    duck_seconds = {name: timed(duck_run(name)) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "duckdb_queries": duck_seconds,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
