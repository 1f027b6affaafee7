import glob

import pytest
import raw_files as rf
from pyspark.sql import functions as F
from test_daily import World

from callscope import schemas
from callscope.operators.quality import QualityError, run_checks
from callscope.plans import daily
from callscope.sources import key_index
from callscope.sources.landing import land_all, land_files
from callscope.sources.tables import Tables

FAR = 1 << key_index.BLOCK_BITS


@pytest.fixture
def world(spark, folder):
    return World(spark, folder)


def entries(tables, table=schemas.DISPOSITIONS):
    rows = tables.read("index", table).select("key", "extract_date").collect()
    return sorted((r["key"], r["extract_date"]) for r in rows)


def files_read(df):
    """Files that the one scan of a plan without shuffles has opened."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numFiles").value()


def spoil(*patterns):
    """Make files unreadable: whoever opens one fails."""
    paths = [p for pattern in patterns for p in glob.glob(rf.local(pattern))]
    for path in paths:
        with open(path, "wb") as f:
            f.write(b"spoilt" * 10)
    return len(paths)


def test_buckets(spark):
    rows = spark.sql(
        f"select * from values ('7'), (' 07'), ('{FAR - 1}'), ('{FAR}'), ('x'), ('y'), ('9999999999999999999999'), (null) t(k)"
    )
    got = {r["k"]: r["b"] for r in rows.select("k", key_index.bucket_of(F.col("k")).alias("b")).collect()}
    assert got["7"] == got[" 07"] == got[str(FAR - 1)] != got[str(FAR)]
    assert all(0 <= b < key_index.BUCKETS for b in got.values())
    numbers = spark.range(5).select((F.col("id") * FAR).alias("k"))
    both = numbers.select(key_index.bucket_of(F.col("k")).alias("n"), key_index.bucket_of(F.col("k").cast("string")).alias("t"))
    assert both.filter("n <> t").isEmpty()


def test_index_follows_landing(spark, folder):
    raw, tables = f"{folder}/raw", Tables(spark, f"{folder}/out")
    rf.write_day(raw, "2024-01-05", dispositions=[rf.disposition(n, 1, "2024-01-05 10:00:00") for n in (1, 2, "")])
    land_all(spark, tables, raw)
    assert entries(tables) == [("1", "2024-01-05"), ("2", "2024-01-05")]
    assert entries(tables, schemas.CALLS) == []
    rf.write_day(raw, "2024-01-05", dispositions=[rf.disposition(FAR, 1, "2024-01-05 10:00:00")])
    rf.write_day(raw, "2024-01-06", dispositions=[rf.disposition(2, 1, "2024-01-06 10:00:00")] * 2)
    paths = [f"{raw}/2024-01-0{d}/{schemas.DISPOSITIONS}.csv" for d in (5, 6)]
    for _ in range(2):  # a replay changes nothing
        land_files(spark, tables, raw, paths)
        assert entries(tables) == [(str(FAR), "2024-01-05"), ("2", "2024-01-06"), ("2", "2024-01-06")]
    shared = key_index.sharing_keys(tables, schemas.DISPOSITIONS, {"2024-01-06"})
    assert [r["key"] for r in shared.collect()] == ["2", "2"]
    assert key_index.sharing_keys(tables, schemas.DISPOSITIONS, set()).count() == 0


def test_only_buckets_of_the_keys_are_opened(spark, folder):
    raw, tables = f"{folder}/raw", Tables(spark, f"{folder}/out")
    for day in range(1, 9):
        rf.write_day(raw, f"2024-01-0{day}", dispositions=[rf.disposition(day * FAR + n, 1, "2024-01-05 10:00:00") for n in range(5)])
    land_all(spark, tables, raw)
    buckets = key_index.buckets_of_extracts(tables, schemas.DISPOSITIONS, {"2024-01-03"})
    everything = tables.read("index", schemas.DISPOSITIONS)
    assert len(buckets) == 1 and files_read(everything) == 8
    assert files_read(key_index.in_buckets(everything, buckets)) == 1


@pytest.mark.parametrize("second", [2, 3 * FAR])
def test_duplicates_by_index_equal_the_full_check(world, second):
    world.day("2024-01-05", dispositions=[rf.disposition(n, 10, "2024-01-05 10:00:00") for n in (1, second, 5 * FAR)])
    world.run("2024-01-05 23:00")
    world.day("2024-01-06", dispositions=[rf.disposition(n, 11, "2024-01-06 10:00:00") for n in (second, 6 * FAR)])
    with pytest.raises(QualityError, match="unique.atlas_calls_dispositions.call_log_id.: 1 violation"):
        world.run("2024-01-06 23:00")
    full, landed = (daily.source_checks(world.tables, x) for x in (None, daily.land(world.spark, world.tables, world.raw)))
    found = [{c.name: sorted(map(tuple, c.violations.collect())) for c in checks} for checks in (full, landed)]
    assert found[0] == found[1]
    assert found[0]["unique(atlas_calls_dispositions.call_log_id)"] == [(str(second), 2)]


def test_a_day_reads_no_history(world):
    """Raw rows older than the lookback and index files of other ids can no longer be read."""
    for day in range(1, 6):
        world.day(
            f"2024-01-0{day}",
            calls=[rf.call(day * FAR, f"2024-01-0{day} 10:00:00", str(day * FAR))],
            dispositions=[rf.disposition(day * FAR, day, f"2024-01-0{day} 10:00:00")],
        )
    world.day(
        "2024-02-20",
        calls=[rf.call(20 * FAR, "2024-02-20 10:00:00", str(2 * FAR))],
        dispositions=[rf.disposition(20 * FAR, 2, "2024-02-20 10:00:00")],
    )
    world.run("2024-02-20 23:00")
    old = world.tables
    near = {r["bucket"] for n in (2, 3, 20, 21) for r in world.spark.sql(f"select {n * FAR}L as k").select(key_index.bucket_of(F.col("k")).alias("bucket")).collect()}
    others = [p for n in (schemas.CALLS, schemas.DISPOSITIONS) for p in old.partitions("index", n) if int(p["bucket"]) not in near]
    assert len(others) == 6
    assert spoil(f"{world.out}/raw/atlas_calls_dispositions/*/event_date=2024-01-0*/*.parquet") == 5
    spoilt = [spoil(f"{world.out}/index/*/extract_date={p['extract_date']}/bucket={p['bucket']}/*.parquet") for p in others]
    assert all(spoilt)
    other_notes = [p for p in old.partitions(*daily.NOTED) if int(p["bucket"]) not in near]
    assert sum(spoil(f"{old.path(*daily.NOTED)}/call_date={p['call_date']}/bucket={p['bucket']}/*.parquet") for p in other_notes) == 3
    # An old id is named by a new call; a new disposition was named by an old call's note.
    world.day(
        "2024-02-21",
        calls=[rf.call(21 * FAR, "2024-02-21 10:00:00", str(3 * FAR))],
        dispositions=[rf.disposition(21 * FAR, 3, "2024-02-21 10:00:00")],
    )
    world.run("2024-02-21 23:00")
    coded = {str(r["call_date"]): r["coded_calls"] for r in old.read(*daily.CODING).collect()}
    assert coded == {f"2024-01-0{d}": 1 for d in range(1, 6)} | {"2024-02-20": 1, "2024-02-21": 1}


def test_days_that_lose_all_their_notes_and_rows(world):
    full = dict(
        calls=[rf.call(n, f"2024-01-0{n} 10:00:00", str(n)) for n in (1, 2)],
        dispositions=[rf.disposition(n, n, f"2024-01-0{n} 10:00:00") for n in (1, 2)],
    )
    world.day("2024-01-02", **full)
    world.run("2024-01-02 23:00")
    for _ in range(2):  # emptied, and emptied folders met again
        world.day("2024-01-02", calls=[rf.call(1, "2024-01-01 10:00:00", "2")])
        world.run("2024-01-03 23:00")
        assert entries(world.tables) == []
        world.day("2024-01-02")
        world.run("2024-01-03 23:00")
    world.day("2024-01-02", **full)
    world.run("2024-01-03 23:00")
    world.assert_like_full_build("2024-01-03 23:00")


def test_warehouse_without_an_index(world):
    world.day("2024-01-05", calls=[rf.call(1, "2024-01-05 10:00:00", "7")], dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")])
    world.run("2024-01-05 23:00")
    fs_path = world.spark._jvm.org.apache.hadoop.fs.Path(f"{world.out}/index")
    fs_path.getFileSystem(world.spark._jsc.hadoopConfiguration()).delete(fs_path, True)
    world.day("2024-01-06", dispositions=[rf.disposition(7, 10, "2024-01-06 10:00:00")])
    world.run("2024-01-06 23:00")
    assert entries(world.tables) == [("1", "2024-01-05"), ("7", "2024-01-06")]
    assert run_checks(daily.source_checks(world.tables))
    world.assert_like_full_build("2024-01-06 23:00")


def test_index_is_dealt_by_entries_not_bytes(spark, folder, monkeypatch):
    """Neighbouring ids are few bytes; a task still writes about as many as it shall."""
    monkeypatch.setattr(key_index, "BLOCK_BITS", 14)
    monkeypatch.setattr(key_index, "SLICE_BITS", 10, raising=False)
    monkeypatch.setattr(key_index, "ENTRIES_PER_TASK", 1000, raising=False)
    tables, entity = Tables(spark, folder), schemas.ENTITIES[schemas.CALLS]
    rows = spark.range(16_000).select(F.col("id").cast("string").alias(entity.key), F.lit("2024-01-01").alias("extract_date"))
    tables.overwrite(rows, "raw", schemas.CALLS, ["extract_date"])
    key_index.update(tables, schemas.CALLS)
    index = tables.read("index", schemas.CALLS)
    per_file = [r.n for r in index.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(per_file) == 16_000 and index.select("key").distinct().count() == 16_000
    assert len(per_file) > 4 and max(per_file) <= 6 * 1024


def test_neighbouring_ids_are_dealt_evenly(spark, folder, monkeypatch):
    """One slice of ids, of two extracts: no task writes much more than its share."""
    monkeypatch.setattr(key_index, "ENTRIES_PER_TASK", 1000)
    raw, tables = f"{folder}/raw", Tables(spark, f"{folder}/out")
    for day, first in (("2024-01-05", 0), ("2024-01-06", 6000)):
        at = f"{day} 10:00:00"
        rf.write_day(raw, day, dispositions=[rf.disposition(n, 1, at) for n in range(first, first + 6000)])
    land_all(spark, tables, raw)
    index = tables.read("index", schemas.DISPOSITIONS)
    per_file = [r["count"] for r in index.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(per_file) == 12000
    assert max(per_file) < 2000
    assert len(per_file) <= 12 + 1  # the two folders share one task at most
