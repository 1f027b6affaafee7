import pytest
import raw_files as rf
from test_daily import World

from callscope.operators.quality import QualityError
from callscope.plans import daily, restate

DAY, KEY = "day", "id"


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_differences_and_replay(spark):
    before = spark.sql(
        "select * from values (date '2024-01-01', 1, 1.0D), (date '2024-01-01', 2, 2.0D), (date '2024-01-01', 3, null),"
        " (date '2024-01-02', 4, double('nan')), (null, 5, 5.0D), (date '2024-01-02', 6, 6.0D) t(day, id, x)"
    )
    after = spark.sql(
        "select * from values (date '2024-01-01', 1, 1.0D), (date '2024-01-01', 2, 2.5D), (date '2024-01-01', 3, null),"
        " (date '2024-01-02', 4, double('nan')), (null, 5, 5.5D), (date '2024-01-01', 6, 6.0D), (date '2024-01-02', 7, 7.0D) t(day, id, x)"
    )
    found = restate.differences(before, after, DAY, KEY)
    got = sorted(
        (str(r["published_date"]), r["kind"], (r["after"] or r["before"])["id"]) for r in found.collect()
    )
    assert got == [
        ("2024-01-01", "added", 6), ("2024-01-01", "changed", 2), ("2024-01-02", "added", 7),
        ("2024-01-02", "removed", 6), ("None", "changed", 5),
    ]
    assert rows_of(restate.replay(before, found, DAY, KEY)) == rows_of(after)
    assert restate.differences(before, before, DAY, KEY).isEmpty()
    assert rows_of(restate.replay(before, restate.differences(before, after.limit(0), DAY, KEY), DAY, KEY)) == []


def test_a_column_that_is_new(spark):
    before = spark.sql("select date '2024-01-01' as day, 1 as id")
    after = spark.sql("select date '2024-01-01' as day, 1 as id, 'x' as more")
    (row,) = restate.differences(before, after, DAY, KEY).collect()
    assert (row["kind"], row["before"]["more"], row["after"]["more"]) == ("changed", None, "x")


def test_late_rows_restate_published_dates(spark, folder):
    world = World(spark, folder)
    marts = list(daily.CHANGE_KEYS)
    world.day(
        "2024-01-05",
        dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00"), rf.disposition(5, 50, "2024-01-05 10:00:00")],
        payments=[rf.payment(10, "2024-01-07 10:00:00", 50)],
    )
    world.run("2024-01-07 23:00", keep_changes=marts)
    assert all(restate.changes(world.tables, m).isEmpty() for m in marts)  # nothing was published before
    old = {m: [tuple(r) for r in world.tables.read(*m).collect()] for m in marts}
    schemas = {m: world.tables.read(*m).schema for m in marts}
    dates = {m: world.tables.dates(*m, daily.CHANGE_KEYS[m][0]) for m in marts}
    # A late call takes the payment over, and its date is new.
    late = dict(dispositions=[rf.disposition(2, 10, "2024-01-06 10:00:00"), rf.disposition(3, 30, "2024-01-05 12:00:00")])
    world.day("2024-01-08", **late, payments=[rf.payment(50, "2024-01-07 12:00:00", 20)])
    with pytest.raises(QualityError):
        world.run("2024-01-08 23:00", keep_changes=marts, providers=["none"])
    world.run("2024-01-08 23:00", keep_changes=marts)
    assert world.tables.commits() == [1, 2]
    moved = restate.moved(
        restate.changes(world.tables, daily.PAID, [2]), payments=restate.F.col("row.attributed_payment_count")
    )
    (row,) = moved.collect()
    assert row.asDict() | {"published_date": str(row["published_date"])} == {
        "commit": 2, "published_date": "2024-01-05", "added": 1, "removed": 0, "changed": 2,
        "payments_before": 1, "payments_after": 1,
    }
    for mart in marts:
        day, key = daily.CHANGE_KEYS[mart]
        before = spark.createDataFrame(old[mart], schemas[mart])
        replayed = restate.replay(before, restate.changes(world.tables, mart, [2]), day, key)
        new = world.tables.read(*mart)
        new = new.filter(new[day].isin(sorted(dates[mart]))) if dates[mart] else new.limit(0)
        assert rows_of(replayed) == rows_of(new), mart
    world.run("2024-01-08 23:00", keep_changes=marts)
    assert all(restate.changes(world.tables, m, [3]).isEmpty() for m in marts)
