import random
from datetime import datetime, timedelta

import pytest

from callscope import session
from callscope.operators import attribution
from callscope.operators.attribution import attribute_payments, with_window_state
from callscope.plans import marts

DISPOSITION = "call_log_id bigint, market string, contract_id bigint, disposed_at_utc timestamp_ntz"
PAYMENT = "contract_id bigint, pay_timestamp_utc timestamp_ntz, currency string, amount_local double"
START = datetime(2024, 1, 1)
WINDOW = timedelta(days=3)
ROUTES = [10**9, 3, 1]


def attribute(spark, dispositions, payments, split_rows=10**9):
    rows = attribute_payments(
        spark.createDataFrame(dispositions, DISPOSITION),
        spark.createDataFrame(payments, PAYMENT),
        split_rows,
    )
    return rows.select(
        "call_log_id",
        "market",
        "contract_id",
        "disposed_at_utc",
        "pay_timestamp_utc",
        "currency",
        "amount_local",
    ).collect()


def by_hand(dispositions, payments):
    """All pairs, in plain Python."""
    owned = {}
    for contract, paid_at, currency, amount in payments:
        if contract is None or paid_at is None or amount is None or not amount > 0:
            continue
        candidates = [
            (at, call)
            for call, _, c, at in dispositions
            if c == contract and at is not None and at <= paid_at <= at + WINDOW
        ]
        if candidates:
            key = (max(candidates)[1], paid_at, amount)
            owned.setdefault(key, []).append(currency)
    rows = []
    for call, market, contract, at in dispositions:
        if contract is None:
            continue
        mine = [(k, c) for k, c in owned.items() if k[0] == call]
        rows += [
            (call, market, contract, at, paid_at, min(currencies), amount)
            for (_, paid_at, amount), currencies in mine
        ] or [(call, market, contract, at, None, None, None)]
    return rows


def same(actual, expected):
    assert sorted(map(tuple, actual), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("split_rows", ROUTES)
def test_window_ends_ties_and_gaps(spark, split_rows):
    hour = timedelta(hours=1)
    dispositions = [
        (1, "Kenya", 10, START),
        (2, None, 10, START + hour),
        (3, "Kenya", 10, START + hour),  # same instant: the larger id wins
        (4, "Uganda", 20, START),
        (5, "Uganda", None, START),  # not assessable
        (6, "Uganda", 30, START),  # never pays
        (7, None, 40, START),
        (8, "Kenya", 50, None),
    ]
    payments = [
        (10, START, "KES", 1.0),  # at the instant of the call
        (10, START + hour, "KES", 2.0),
        (10, START + 2 * hour, "KES", 3.0),
        (10, START + 2 * hour, "KES", 3.0),  # a copy counts once
        (10, START + 2 * hour, "KES", 4.0),
        (10, START - hour, "KES", 5.0),  # before any call
        (20, START + WINDOW, "UGX", 6.0),  # the last moment
        (20, START + WINDOW + timedelta(microseconds=1), "UGX", 7.0),  # too late
        (None, START, "KES", 8.0),
        (40, START + hour, None, 9.0),
        (40, START + hour, "KES", 0.0),
        (40, START + hour, "KES", -1.0),
        (40, None, "KES", 1.0),
        (50, START, "KES", 1.0),  # only a call without a time
        (60, START, "KES", 1.0),  # no call at all
    ]
    actual = attribute(spark, dispositions, payments, split_rows)
    got = {(r["call_log_id"], r["amount_local"]) for r in actual}
    assert got == {
        (1, 1.0),
        (2, None),
        (3, 2.0),
        (3, 3.0),
        (3, 4.0),
        (4, 6.0),
        (6, None),
        (7, 9.0),
        (8, None),
    }
    assert len(actual) == len(got)
    assert {r["market"] for r in actual if r["call_log_id"] in (2, 7)} == {None}


@pytest.mark.parametrize("split_rows", ROUTES)
@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed, split_rows):
    """Random timelines, a third of all rows on one contract."""
    rng = random.Random(seed)
    span = rng.choice([86400, 20 * 86400, 200 * 86400])

    def contract():
        return 1 if rng.random() < 0.35 else rng.choice([None, 2, 3, 4, 5, 6])

    def moment():
        seconds = rng.randrange(span)
        return START + timedelta(seconds=seconds - seconds % rng.choice([1, 3600, 86400]))

    dispositions = [(i, rng.choice(["Kenya", None]), contract(), moment()) for i in range(120)]
    payments = [
        (contract(), moment(), rng.choice(["KES", "UGX"]), float(rng.randrange(-1, 4)))
        for _ in range(200)
    ]
    same(
        attribute(spark, dispositions, payments, split_rows), by_hand(dispositions, payments)
    )


def test_no_payment_is_claimed_twice_and_no_call_is_lost(spark):
    rng = random.Random(9)
    dispositions = [
        (i, "Kenya", rng.randrange(4), START + timedelta(hours=rng.randrange(400)))
        for i in range(200)
    ]
    payments = [
        (rng.randrange(4), START + timedelta(minutes=rng.randrange(24000)), "KES", float(i + 1))
        for i in range(300)
    ]
    rows = attribute(spark, dispositions, payments)
    amounts = [r["amount_local"] for r in rows if r["amount_local"]]
    assert len(amounts) == len(set(amounts))
    assert {r["call_log_id"] for r in rows} == set(range(200))


def test_window_state_and_collapse(spark):
    dispositions = [(1, "Kenya", 1, START), (2, "Kenya", 2, START + timedelta(hours=1))]
    payments = [(1, START, "KES", 1.0), (1, START + timedelta(hours=2), "KES", 2.0)]
    attributed = attribute_payments(
        spark.createDataFrame(dispositions, DISPOSITION), spark.createDataFrame(payments, PAYMENT)
    )
    state = with_window_state(attributed, as_of=START + WINDOW)
    paid = {r["call_log_id"]: r for r in marts.fct_paid_post_call(state).collect()}
    assert paid[1]["is_window_closed"] and not paid[2]["is_window_closed"]
    assert (paid[1]["is_paid_post_call"], paid[1]["attributed_payment_count"]) == (True, 2)
    assert (paid[2]["is_paid_post_call"], paid[2]["attributed_payment_count"]) == (False, 0)
    assert paid[1]["window_closes_at_utc"] == START + WINDOW


@pytest.mark.parametrize("segments", [2, 7, 40])
def test_one_second_in_many_segments(spark, monkeypatch, segments):
    """All rows of one contract in one second, most of them equal; others around it."""
    rng = random.Random(segments)
    monkeypatch.setattr(attribution, "segments_for", lambda timeline, load: segments)
    micro = timedelta(microseconds=1)
    dispositions = [(i, "Kenya", 5, START + rng.randrange(30) * micro) for i in range(60)]
    dispositions += [(100 + i, None, i % 9, START - timedelta(days=i % 5)) for i in range(40)]
    payments = [(5, START + rng.randrange(60) * micro, "KES", float(rng.randrange(1, 3))) for _ in range(150)]
    payments += [(5, START + timedelta(days=2), "KES", 1.0)] * 50
    payments += [(i % 9, START + timedelta(days=i % 4), "UGX", 2.0) for i in range(30)]
    same(attribute(spark, dispositions, payments, split_rows=1), by_hand(dispositions, payments))


def test_segments_share_one_instant_evenly(spark):
    """Equal rows of one contract and instant lie in all segments."""
    rows = spark.range(60_000).selectExpr(
        "1L as contract_id", "timestamp_ntz '2024-01-01 10:00:00' as at",
        "cast(null as bigint) as call_log_id", "'KES' as currency", "5.0D as amount_local",
    )
    sizes = [r["count"] for r in attribution.in_segments(rows, 12).groupBy("segment").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 60_000 / 12


def test_plan_without_heavy_contracts(spark):
    """Each input is read once, and one shuffle on the contract brings both together."""
    folder = session.shared_folder(spark, "plan")
    spark.createDataFrame([(1, "Kenya", 1, START)], DISPOSITION).write.parquet(f"{folder}/d")
    spark.createDataFrame([(1, START, "KES", 1.0)], PAYMENT).write.parquet(f"{folder}/p")
    rows = attribute_payments(spark.read.parquet(f"{folder}/d"), spark.read.parquet(f"{folder}/p"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1


def test_no_pairs(spark):
    dispositions = spark.range(100).selectExpr(
        "id as call_log_id", "'Kenya' as market", "id % 9 as contract_id",
        "timestamp_ntz '2024-01-01' + make_dt_interval(0, int(id)) as disposed_at_utc",
    )
    payments = spark.range(100).selectExpr(
        "id % 9 as contract_id",
        "timestamp_ntz '2024-01-02' + make_dt_interval(0, int(id)) as pay_timestamp_utc",
        "'KES' as currency", "1.0D as amount_local",
    )
    state = with_window_state(attribute_payments(dispositions, payments), START)
    plan = marts.fct_paid_post_call(state)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Cartesian", "NestedLoop"))
