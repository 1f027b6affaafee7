import os
import random
from datetime import date, datetime, timedelta

import pytest
import raw_files as rf
from pyspark.sql import functions as F

from callscope.operators.quality import QualityError, run_checks
from callscope.plans import daily
from callscope.sources.tables import Tables, list_files
from callscope.streaming.ingest import ingest_stream, refresh_stream

MARTS = (daily.ATTRIBUTION, *daily.MARTS)


class World:
    """A raw folder, a warehouse, and a second warehouse to build from scratch."""

    def __init__(self, spark, folder):
        self.spark, self.raw = spark, f"{folder}/raw"
        self.out, self.fresh = f"{folder}/out", f"{folder}/fresh"
        self.tables = Tables(spark, self.out)
        self.fx = rf.write_text(f"{folder}/fx/latest.json", rf.FX)

    def day(self, day, **rows):
        rf.write_day(self.raw, day, **rows)

    def run(self, day, out=None, **options):
        return daily.run_daily(
            self.spark, self.raw, out or self.out, datetime.fromisoformat(day),
            fx_payload=self.fx, **options,
        )

    def rows(self, table, out=None):
        """Without the date of the rate: a fresh warehouse knows only the latest day's."""
        df = Tables(self.spark, out or self.out).read(*table).drop("fx_rate_date_used")
        return sorted(map(tuple, df.collect()), key=repr)

    def paid(self):
        return {
            r["call_log_id"]: (r["is_paid_post_call"], r["is_window_closed"], r["attributed_payment_count"])
            for r in self.tables.read(*daily.PAID).collect()
        }

    def assert_like_full_build(self, day):
        self.run(day, out=self.fresh, full_refresh=True)
        for table in MARTS:
            assert self.rows(table) == self.rows(table, self.fresh), table


@pytest.fixture
def world(spark, folder):
    return World(spark, folder)


def test_unpaid_then_paid_then_closed(world):
    world.day("2024-01-05", dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")])
    world.run("2024-01-05 23:00")
    assert world.paid() == {1: (False, False, 0)}
    world.day("2024-01-06", payments=[rf.payment(10, "2024-01-06 10:00:00", 50)])
    world.run("2024-01-06 23:00")
    assert world.paid() == {1: (True, False, 1)}
    assert len(world.rows(daily.ATTRIBUTION)) == 1
    world.day("2024-01-10", calls=[rf.call(1, "2024-01-05 10:00:00", "1\n")])
    world.run("2024-01-10 23:00")
    assert world.paid() == {1: (True, True, 1)}
    (value,) = world.tables.read(*daily.VALUE).collect()
    assert (value["call_date"], value["market"], value["value_recovered_usd"]) == (
        date(2024, 1, 6), "Kenya", 0.5,
    )
    (coding,) = world.tables.read(*daily.CODING).collect()
    assert (coding["coded_calls"], coding["total_calls"], coding["atlas_user_name"]) == (1, 1, "ann")
    (driver,) = world.tables.read(*daily.DRIVERS).collect()
    assert (driver["level_one"], driver["level_two"], driver["call_count"]) == ("Enquiry", None, 1)
    world.assert_like_full_build("2024-01-10 23:00")


def test_late_rows_move_payments_and_rerun_changes_nothing(world):
    world.day(
        "2024-01-05",
        dispositions=[
            rf.disposition(1, 10, "2024-01-05 10:00:00"),
            rf.disposition(9, 90, "2024-01-20 10:00:00"),
        ],
        payments=[rf.payment(10, "2024-01-07 10:00:00", 50)],
    )
    world.run("2024-01-20 23:00")
    assert world.paid()[1] == (True, True, 1)
    # Beyond the lookback: a call takes the payment over, and another old payment shows up.
    world.day(
        "2024-01-21",
        dispositions=[rf.disposition(2, 10, "2024-01-06 10:00:00")],
        payments=[rf.payment(10, "2024-01-05 11:00:00", 70)],
    )
    world.run("2024-01-21 23:00")
    assert world.paid()[1] == (True, True, 1) and world.paid()[2] == (True, True, 1)
    amounts = [r["amount_local"] for r in world.tables.read(*daily.ATTRIBUTION).collect()]
    assert sorted(a for a in amounts if a) == [50.0, 70.0]
    world.assert_like_full_build("2024-01-21 23:00")
    before = [world.rows(t) for t in MARTS]
    report = world.run("2024-01-21 23:00")
    assert report.landed == []
    assert [world.rows(t) for t in MARTS] == before


def test_partition_that_becomes_empty(world):
    world.day(
        "2024-01-05",
        dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")],
        payments=[rf.payment(10, "2024-01-06 10:00:00", 50)],
    )
    world.day("2024-01-06", dispositions=[rf.disposition(2, 10, "2024-01-04 10:00:00")])
    world.run("2024-01-06 23:00")
    # The corrected extract has neither the call nor the payment.
    world.day("2024-01-05")
    world.run("2024-01-07 23:00")
    assert set(world.paid()) == {2}
    assert world.tables.dates(*daily.VALUE, "call_date") == set()
    world.assert_like_full_build("2024-01-07 23:00")


def test_earlier_as_of_and_split_route(world):
    world.day(
        "2024-01-05",
        dispositions=[
            rf.disposition(n, n % 2, f"2024-01-{n:02d} 10:00:00") for n in range(1, 25)
        ],
        payments=[rf.payment(n % 2, f"2024-01-{n:02d} 12:00:00", n) for n in range(1, 25)],
    )
    world.run("2024-01-24 23:00", split_rows=3)
    world.run("2024-01-06 23:00", split_rows=3)
    world.assert_like_full_build("2024-01-06 23:00")
    world.run("2024-02-24 23:00")
    assert all(closed for _, closed, _ in world.paid().values())


def test_failed_run_is_repeated_with_the_same_files(world):
    world.day("2024-01-05", dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")])
    world.run("2024-01-30 23:00")
    duplicate = rf.disposition(1, 10, "2024-01-05 10:00:00")
    world.day("2024-01-06", dispositions=[duplicate])
    with pytest.raises(QualityError, match="unique.atlas_calls_dispositions.call_log_id"):
        world.run("2024-01-31 23:00")
    late = rf.disposition(3, 10, "2024-01-05 11:00:00")
    world.day("2024-01-06", dispositions=[late])
    world.run("2024-01-31 23:00")
    assert set(world.paid()) == {1, 3}


def test_marts_are_published_together_after_their_checks(world):
    world.day(
        "2024-01-05",
        calls=[rf.call(1, "2024-01-05 09:00:00", note="1")],
        dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")],
        payments=[rf.payment(10, "2024-01-05 11:00:00", 5)],
    )
    world.run("2024-01-05 23:00")
    before = {t: world.rows(t) for t in daily.MARTS}
    commits = world.tables.commits()
    world.day(
        "2024-01-06",
        calls=[rf.call(2, "2024-01-06 09:00:00", note="2")],
        dispositions=[rf.disposition(2, 10, "2024-01-06 10:00:00")],
        payments=[rf.payment(10, "2024-01-06 11:00:00", 7)],
    )
    with pytest.raises(QualityError, match="accepted_values"):
        world.run("2024-01-06 23:00", providers=["NOBODY"])
    assert {t: world.rows(t) for t in daily.MARTS} == before
    assert world.tables.commits() == commits
    runs = {f.split("/run=")[1].split("/")[0] for f in list_files(world.spark, f"{world.out}/marts/*/run=*/*/*")}
    assert len(runs) == 1  # what failed is gone
    world.run("2024-01-06 23:00")
    assert set(world.paid()) == {1, 2} and len(world.tables.commits()) == len(commits) + 1
    world.assert_like_full_build("2024-01-06 23:00")


def test_readers_see_the_last_commit_only(spark, folder):
    tables, other = Tables(spark, folder), Tables(spark, folder)

    def rows(n, extra=""):
        return spark.sql(f"select id as n, date '2024-01-01' + int(id % 3) as day, 'x' as text {extra} from range({n})")

    tables.overwrite(rows(6), "marts", "a", ["day"])
    with tables.publishing():
        only = date(2024, 1, 2)
        tables.replace_partitions(rows(9).filter(F.col("day") == only), "marts", "a", ["day"], lambda p: p["day"] == str(only))
        tables.overwrite(rows(2), "marts", "b")
        assert (tables.read("marts", "a").count(), other.read("marts", "a").count()) == (7, 6)
        assert not other.exists("marts", "b")
    assert (other.read("marts", "a").count(), other.read("marts", "b").count()) == (7, 2)
    assert other.dates("marts", "a", "day") == {date(2024, 1, d) for d in (1, 2, 3)}
    tables.replace_partitions(rows(0), "marts", "a", ["day"], lambda p: p["day"] == "2024-01-03")
    assert other.dates("marts", "a", "day") == {date(2024, 1, 1), date(2024, 1, 2)}
    for n in range(4):
        tables.overwrite(rows(n), "marts", "b")
    assert other.read("marts", "a").count() == 5 and len(tables.commits()) == 3
    database = f"c{os.path.basename(folder).replace('-', '_')}"
    assert tables.register("marts", "a", database).count() == 5
    tables.overwrite(rows(3, ", 1 as more"), "marts", "a", ["day"])
    assert tables.register("marts", "a", database).select("more", "day").distinct().count() == 3
    assert tables.register("marts", "b", database).count() == 3
    with tables.publishing():
        other.overwrite(rows(4), "marts", "b")
        tables.overwrite(rows(5), "marts", "b")
        with pytest.raises(Exception, match="xist"):
            tables._commit()
        tables._open = (tables._open[0] + 1, *tables._open[1:])


def test_unknown_currency_fails_the_run(world):
    world.day(
        "2024-01-05",
        dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")],
        payments=[rf.payment(10, "2024-01-05 11:00:00", 5, tenant=999)],
    )
    with pytest.raises(QualityError, match="rate for every attributed payment"):
        world.run("2024-01-05 23:00")


def test_stream_lands_each_file_once(world):
    world.day("2024-01-05", payments=[rf.payment(1, "2024-01-05 10:00:00", 5)])
    seen = []

    def start():
        ingest_stream(
            world.spark, world.raw, world.out, f"{world.out}/checkpoint",
            on_landed=lambda _, landed: seen.append({r.table: r.rows for r in landed}),
        ).awaitTermination()

    start()
    start()
    assert len(seen) == 1 and seen[0]["atlas_payments"] == 1
    world.day("2024-01-06", payments=[rf.payment(2, "2024-01-06 10:00:00", 5)] * 2)
    start()
    assert len(seen) == 2 and seen[1]["atlas_payments"] == 2
    assert world.tables.read("raw", "atlas_payments").count() == 3


def test_stream_keeps_marts_like_a_full_build(world):
    daily.fx.load_payload(world.tables, world.fx, datetime(2024, 1, 31))
    days = {
        "2024-01-05": dict(
            dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")],
            payments=[rf.payment(10, "2024-01-07 10:00:00", 50)],
            calls=[rf.call(1, "2024-01-05 09:00:00", "1")],
        ),
        "2024-01-09": dict(dispositions=[rf.disposition(2, 10, "2024-01-06 10:00:00")]),
        "2024-01-31": dict(payments=[rf.payment(10, "2024-01-05 11:00:00", 70)]),
    }
    for day, rows in days.items():
        world.day(day, **rows)
        refresh_stream(
            world.spark, world.raw, world.out, f"{world.out}/checkpoint",
            clock=lambda: datetime(2024, 1, 31),
        ).awaitTermination()
    world.assert_like_full_build("2024-01-31")


@pytest.mark.parametrize("seed", [1])
def test_random_arrivals_and_corrections_equal_a_full_build(world, seed):
    """Rows arrive up to nine days late; later days also correct extracts of earlier ones."""
    rng = random.Random(seed)

    def moment():
        return datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 12))

    def arrival(at):
        return min(at + timedelta(days=rng.choice([0, 0, 1, 2, 9])), datetime(2024, 1, 12)).date()

    dispositions, payments, calls = {}, {}, {}
    for n in range(90):
        at = moment()
        row = rf.disposition(
            n, rng.choice([1, 1, 2, 3, ""]), rng.choice([str(at)] * 9 + [""]), 1001 + n % 4
        )
        dispositions.setdefault(arrival(at), []).append(row)
    for n in range(120):
        at = moment()
        row = rf.payment(rng.choice([1, 1, 2, 3, 4]), str(at), rng.randrange(-1, 6))
        payments.setdefault(arrival(at), []).append(row)
    for n in range(40):
        at = moment()
        calls.setdefault(at.date(), []).append(rf.call(n, str(at), rng.choice(["", "x", "zz\n7", *map(str, range(0, 90, 3))])))
    for run in (date(2024, 1, 4), date(2024, 1, 8), date(2024, 1, 12)):
        due = [date(2024, 1, 1) + timedelta(n) for n in range(run.day)]
        for day in due:
            if day < run and rng.random() < 0.2:
                payments[day] = payments.get(day, [])[1:]
                dispositions[day] = dispositions.get(day, [])[1:]
            world.day(
                str(day),
                dispositions=dispositions.get(day, []),
                payments=payments.get(day, []),
                calls=calls.get(day, []),
            )
        world.run(f"{run} 23:00", split_rows=20)
        world.assert_like_full_build(f"{run} 23:00")


def test_calls_are_coded_again_when_what_they_name_changes(world):
    call = [rf.call(1, "2024-01-05 10:00:00", "7"), rf.call(2, "2024-01-06 10:00:00", "8")]
    first = [rf.disposition(8, 10, "2024-01-05 10:00:00")]
    world.day("2024-01-05", calls=call, dispositions=first)
    world.day("2024-01-20", calls=[rf.call(3, "2024-01-20 10:00:00", "")])
    world.run("2024-01-20 23:00")
    # Long after the lookback: a disposition arrives, another is corrected away, an agent is renamed.
    world.day("2024-01-05", calls=call)
    world.day(
        "2024-01-21",
        dispositions=[rf.disposition(7, 10, "2024-01-04 10:00:00")],
        mapping=[("Kenya", "u1", "T", "aaa")],
    )
    world.run("2024-01-21 23:00")
    coded = {r["call_date"].day: (r["coded_calls"], r["atlas_user_name"]) for r in world.tables.read(*daily.CODING).collect()}
    assert coded == {5: (1, "aaa"), 6: (0, "aaa"), 20: (0, "aaa")}
    world.assert_like_full_build("2024-01-21 23:00")


def test_removed_extracts_leave_no_rows(world):
    world.day("2024-01-05", dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")])
    rf.write(world.raw, "2024-01-06", "atlas_calls_dispositions", [rf.disposition(2, 10, "2024-01-06 10:00:00")])
    world.run("2024-01-06 23:00")
    assert set(world.paid()) == {1, 2}
    os.remove(rf.local(f"{world.raw}/2024-01-06/atlas_calls_dispositions.csv"))
    world.run("2024-01-07 23:00")
    assert set(world.paid()) == {1}
    world.assert_like_full_build("2024-01-07 23:00")


def test_drift_checks(world):
    world.day(
        "2024-01-05",
        dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")],
        payments=[rf.payment(10, "2024-01-05 11:00:00", 5)],
        calls=[rf.call(1, "2024-01-05 10:00:00", "1"), rf.call(2, "2024-01-05 10:00:00", " ")],
    )
    world.run("2024-01-05 23:00")
    assert run_checks(daily.drift_checks(world.tables, 0.5, ["MPESA"]))
    with pytest.raises(QualityError, match="blank_share.*accepted_values"):
        run_checks(daily.drift_checks(world.tables, 0.4, ["CARD"]))
    with pytest.raises(QualityError, match="accepted_values"):
        world.run("2024-01-05 23:00", providers=["CARD"])
