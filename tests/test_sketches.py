"""Sketches per extract against the exact figures of the same rows."""

import random
from bisect import bisect_left, bisect_right

import raw_files as rf
from pyspark.sql import functions as F
from test_daily import World

from callscope import schemas
from callscope.plans import sketches
from callscope.sources.landing import land_all, land_files
from callscope.sources.tables import Tables


def figures(tables, since=None, until=None):
    c, d, p = (sketches.of_extracts(tables, t, since, until) for t in (schemas.CALLS, schemas.DISPOSITIONS, schemas.PAYMENTS))
    return tuple(sketches.note_ids(c, d).head()), tuple(sketches.contract_load(d, p).head())


def exact(calls, dispositions, payments):
    notes = [n.strip() for _, n in calls if n.strip()]
    ids = {int(n) for n in notes if n.isdigit()}
    moments = {(c, t) for _, c, t in dispositions if c != ""}
    rows = [c for _, c, _ in dispositions if c != ""]
    called, paying = set(rows), {c for c, _ in payments if c != ""}
    return (
        (len(notes), sum(not n.isdigit() for n in notes), len(ids), len(ids & {n for n, _, _ in dispositions})),
        (len(called), len(paying), len(called & paying), len(rows) - len(moments), max(map(rows.count, called), default=0)),
    )


def rows_of_day(rng, day):
    at = [f"{day} 1{rng.randrange(3)}:00:00" for _ in range(40)]
    calls = [(t, rng.choice(["", "  ", "hello", str(rng.randrange(60)), f" {rng.randrange(60)} "])) for t in at]
    dispositions = [(rng.randrange(60), rng.choice(["", 1, 1, rng.randrange(30)]), t) for t in at]
    payments = [(rng.choice(["", rng.randrange(30)]), t) for t in at[:25]]
    return calls, dispositions, payments


def write(raw, day, calls, dispositions, payments):
    rf.write_day(
        raw, day,
        calls=[rf.call(int(day[-2:]) * 1000 + n, t, note) for n, (t, note) in enumerate(calls)],
        dispositions=[rf.disposition(*d[:3]) for d in dispositions],
        payments=[rf.payment(c, t, 5) for c, t in payments],
    )


def test_merged_figures_are_those_of_all_rows(spark, folder):
    raw, tables, rng = f"{folder}/raw", Tables(spark, f"{folder}/out"), random.Random(5)
    days = {f"2024-01-0{n}": rows_of_day(rng, f"2024-01-0{n}") for n in range(1, 5)}
    for day, rows in days.items():
        write(raw, day, *rows)
    land_all(spark, tables, raw)
    for table in (schemas.CALLS, schemas.DISPOSITIONS, schemas.PAYMENTS, schemas.AGENT_MAPPING):
        sketches.update(tables, table)
    together = lambda parts: [sum(x, []) for x in zip(*parts, strict=True)]
    assert figures(tables) == exact(*together(days.values()))
    assert figures(tables, "2024-01-02", "2024-01-03") == exact(*together([days["2024-01-02"], days["2024-01-03"]]))
    assert figures(tables, "2030-01-01") == ((0, 0, 0, 0), (0, 0, 0, 0, 0))
    # a corrected extract replaces its sketches, and no other is opened
    days["2024-01-02"] = rows_of_day(rng, "2024-01-02")
    write(raw, "2024-01-02", *days["2024-01-02"])
    names = (schemas.CALLS, schemas.DISPOSITIONS, schemas.PAYMENTS)
    land_files(spark, tables, raw, [f"{raw}/2024-01-02/{n}.csv" for n in names])
    for table in names:
        sketches.update(tables, table, {"2024-01-02"})
        assert sketches.of_extracts(tables, table).count() == 4
        assert all("/sketches/" in f for f in sketches.of_extracts(tables, table).inputFiles())
    assert figures(tables) == exact(*together(days.values()))


def test_nulls_and_extracts_without_values(spark, folder):
    raw, tables = f"{folder}/raw", Tables(spark, f"{folder}/out")
    write(raw, "2024-01-01", [("2024-01-01 10:00:00", "")], [(1, "", "2024-01-01 10:00:00")], [("", "2024-01-01 10:00:00")])
    land_all(spark, tables, raw)
    for table in (schemas.CALLS, schemas.DISPOSITIONS, schemas.PAYMENTS):
        sketches.update(tables, table)
    assert figures(tables) == ((0, 0, 0, 0), (0, 0, 0, 0, 0))


def test_figures_beyond_the_exact_range_keep_their_error(spark, folder):
    """Three extracts of 150,000 dispositions each, 300,000 different contracts."""
    tables, n = Tables(spark, f"{folder}/out"), 150_000
    raw = spark.range(3 * n).select(
        F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("extract_date"),
        F.col("id").cast("string").alias("call_log_id"),
        F.when(F.col("id") % 30 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(2 * n))).cast("string").alias("contract_id"),
        F.lit("2024-01-01 10:00:00").alias("created_timestamp_utc"),
        (F.col("id") * F.col("id") % 99991).cast("string").alias("amount"),
    )
    tables.overwrite(raw, "raw", schemas.DISPOSITIONS, ["extract_date"])
    tables.overwrite(raw.filter("cast(call_log_id as bigint) % 2 = 0"), "raw", schemas.PAYMENTS, ["extract_date"])
    for table in (schemas.DISPOSITIONS, schemas.PAYMENTS):
        sketches.update(tables, table)
    d, p = (sketches.of_extracts(tables, t) for t in (schemas.DISPOSITIONS, schemas.PAYMENTS))
    called, paying, both, tied, most = sketches.contract_load(d, p).head()
    contracts = tables.read("raw", schemas.DISPOSITIONS).groupBy("contract_id").count()
    true_called = contracts.count()
    true_paying = tables.read("raw", schemas.PAYMENTS).select("contract_id").distinct().count()
    assert abs(called / true_called - 1) < 0.012 and abs(paying / true_paying - 1) < 0.012
    assert abs(both - true_paying) < 0.012 * true_called
    assert abs(tied - (3 * n - true_called)) < 0.012 * true_called
    true_most = contracts.agg(F.max("count")).head()[0]
    assert true_most <= most <= true_most + 3.5 / sketches.FREQUENT * 3 * n
    amounts = sorted(float(r[0]) for r in tables.read("raw", schemas.PAYMENTS).select("amount").collect())
    for rank, amount in sketches.amount_quantiles(p, (0.1, 0.5, 0.99)).collect():
        low, high = (f(amounts, amount) / len(amounts) for f in (bisect_left, bisect_right))
        assert low - 0.025 <= rank <= high + 0.025
    assert sketches.amount_quantiles(p.limit(0), (0.5,)).collect() == []


def test_daily_run_keeps_sketches(spark, folder):
    world = World(spark, folder)
    first = ([("2024-01-05 09:00:00", "1")], [(1, 4, "2024-01-05 10:00:00")], [(4, "2024-01-05 11:00:00")])
    write(world.raw, "2024-01-05", *first)
    world.run("2024-01-05 23:00", keep_sketches=True)
    late = ([("2024-01-06 09:00:00", "x")], [(2, 5, "2024-01-06 10:00:00")], [(4, "2024-01-06 11:00:00")])
    write(world.raw, "2024-01-06", *late)
    world.run("2024-01-06 23:00", keep_sketches=True)
    assert figures(world.tables) == exact(*(a + b for a, b in zip(first, late, strict=True)))
