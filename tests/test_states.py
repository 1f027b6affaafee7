from datetime import date

import raw_files as rf
from pyspark.sql import functions as F
from test_daily import World

from callscope.plans import daily, rollups, states


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def rollups_of(tables, read, paid):
    """The roll-ups, read from marts or from states."""
    return [
        rows_of(rollups.coding_rate_overall(read(daily.CODING))),
        rows_of(paid(read(daily.PAID))),
        rows_of(rollups.value_recovered_by_market(read(daily.VALUE))),
        rows_of(rollups.top_drivers(read(daily.DRIVERS), 2)),
        rows_of(rollups.driver_drill_down(read(daily.DRIVERS))),
    ]


def assert_states_give_the_rollups(tables, since=None, until=None):
    def from_marts(mart):
        day = F.col(states.STATES[mart[1]].day)
        rows = tables.read(*mart)
        return rows.filter(day.between(F.lit(since), F.lit(until))) if since else rows

    def from_states(mart):
        rows = states.period(tables, mart, since, until)
        assert all(f"/states/{mart[1]}/" in f for f in rows.inputFiles())
        return rows

    expected = rollups_of(tables, from_marts, rollups.paid_post_call_overall)
    assert rollups_of(tables, from_states, rollups.paid_post_call_of_states) == expected
    return expected


def test_states_follow_the_marts(spark, folder):
    world = World(spark, folder)
    world.day(
        "2024-01-05",
        calls=[rf.call(n, f"2024-01-0{n} 09:00:00", str(n)) for n in range(1, 6)],
        dispositions=[rf.disposition(n, n, f"2024-01-0{n} 10:00:00", level_one=f"L{n % 2}") for n in range(1, 6)],
        payments=[rf.payment(n, f"2024-01-0{n} 11:00:00", 50 * n) for n in (1, 2, 4)],
    )
    world.run("2024-01-06 23:00")
    first = assert_states_give_the_rollups(world.tables)
    # Late rows, and an extract that is taken back: its dates have neither mart rows nor states.
    world.day("2024-01-05", calls=[rf.call(1, "2024-01-01 09:00:00", "9")], dispositions=[rf.disposition(9, 9, "2024-01-05 10:00:00")])
    world.run("2024-01-09 23:00")
    assert assert_states_give_the_rollups(world.tables) != first
    assert_states_give_the_rollups(world.tables, date(2024, 1, 1), date(2024, 1, 3))
    assert_states_give_the_rollups(world.tables, date(2030, 1, 1), date(2030, 1, 3))
    for mart, state in ((m, states.STATES[m[1]]) for m in daily.CHANGE_KEYS):
        assert world.tables.dates(states.SCHEMA, mart[1], state.day) == world.tables.dates(*mart, state.day)


def test_states_of_an_older_warehouse(spark, folder):
    world = World(spark, folder)
    world.day("2024-01-05", dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")], calls=[rf.call(1, "2024-01-05 10:00:00", "1")])
    world.day("2024-02-05", dispositions=[rf.disposition(2, 10, "2024-02-05 10:00:00")], calls=[rf.call(2, "2024-02-05 10:00:00", "")])
    world.run("2024-02-05 23:00")
    with world.tables.publishing():
        for name in [n for n in world.tables._open[2] if n.startswith("states.")]:
            del world.tables._open[2][name]
    world.run("2024-02-06 23:00")
    assert_states_give_the_rollups(world.tables)
