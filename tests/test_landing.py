import os
import shutil
from datetime import date

import pytest
import raw_files as rf
from pyspark.sql import functions as F

from callscope import schemas
from callscope.sources import landing, manifest
from callscope.sources.tables import Tables

CALLS = schemas.ENTITIES[schemas.CALLS]
PAYMENTS = schemas.ENTITIES[schemas.PAYMENTS]


def read_calls(spark, raw_dir):
    return landing.read_extracts(spark, CALLS, landing.extract_files(spark, raw_dir, CALLS))


def test_names_bind_columns_and_quotes_hold_newlines(spark, folder):
    rf.write(folder, "2024-01-05", CALLS.name, [rf.call(1, "2024-01-05 10:00:00", "a\nb, \"c\" ")])
    columns = rf.COLUMNS[CALLS.name].split()
    late = dict(zip(columns, rf.call(2, "2024-01-06 10:00:00", "7"), strict=True))
    late["extra"] = "x"
    del late["campaign_name"]
    reordered = list(reversed(late))
    rf.write(folder, "2024-01-06", CALLS.name, [[late[c] for c in reordered]], reordered)
    first, second = read_calls(spark, folder).orderBy("ch_call_id").collect()
    assert first["udh_notes"] == 'a\nb, "c" '
    assert first["campaign_name"] == "camp"
    assert (second["ch_call_id"], second["udh_notes"]) == ("2", "7")
    assert second["campaign_name"] is None
    assert "extra" not in second.asDict()
    assert second["extract_date"] == "2024-01-06"
    assert second["event_date"] == date(2024, 1, 6)
    assert second["_source_file"] == (
        os.path.basename(folder) + "/2024-01-06/ameyo_outbound_calls.csv"
    )
    assert second["_loaded_at"] is not None


def test_empty_fields_are_null_quoted_or_not(spark, folder):
    path = rf.write(folder, "2024-01-05", PAYMENTS.name, [])
    with open(path, "a") as f:
        f.write('2024-01-05 10:00:00,1001,,"",p,5\n')
    raw = landing.read_extracts(spark, PAYMENTS, landing.extract_files(spark, folder, PAYMENTS))
    row = raw.head()
    assert row["contract_id"] is None and row["payment_request_provider"] is None


def test_extract_in_parts(spark, folder):
    for n in (1, 2):
        rows = [rf.call(n, "2024-01-05 10:00:00", str(n))]
        rf.write(folder, "2024-01-05", CALLS.name, rows, part=f"part-{n}.csv")
    rf.write_text(f"{folder}/2024-01-05/{CALLS.name}.csv/_SUCCESS", "")
    assert {r["ch_call_id"] for r in read_calls(spark, folder).collect()} == {"1", "2"}


def test_part_with_another_header_fails(spark, folder):
    rows = [rf.call(1, "2024-01-05 10:00:00", "1")]
    rf.write(folder, "2024-01-05", CALLS.name, rows, part="part-1.csv")
    columns = list(reversed(rf.COLUMNS[CALLS.name].split()))
    rf.write(folder, "2024-01-05", CALLS.name, [rows[0][::-1]], columns, part="part-2.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_calls(spark, folder).collect()


def test_malformed_row_fails(spark, folder):
    rf.write(folder, "2024-01-05", PAYMENTS.name, [["2024-01-05 10:00:00", 1001, 5]])
    raw = landing.read_extracts(spark, PAYMENTS, landing.extract_files(spark, folder, PAYMENTS))
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.collect()


def test_missing_extract_fails(spark, folder):
    rf.write(folder, "2024-01-05", CALLS.name, [])
    with pytest.raises(landing.MissingExtract, match="atlas_calls_dispositions"):
        landing.land_all(spark, Tables(spark, f"{folder}/out"), folder)


def test_only_changed_files_are_landed_and_replace_their_rows(spark, folder):
    raw_dir, tables = f"{folder}/raw", Tables(spark, f"{folder}/out")
    one = rf.payment(1, "2024-01-05 10:00:00", 5)
    two = rf.payment(2, "2024-01-06 10:00:00", 6)
    rf.write(raw_dir, "2024-01-05", PAYMENTS.name, [one, two])
    rf.write(raw_dir, "2024-01-06", PAYMENTS.name, [two])
    hashes = manifest.file_hashes(spark, raw_dir)
    landing.land_files(spark, tables, raw_dir, [r["path"] for r in hashes.collect()])
    manifest.remember(tables, hashes)

    def changed():
        known = manifest.known_files(tables)
        hashes = manifest.file_hashes(spark, raw_dir, known)
        assert hashes.count() == 2
        return [r["path"] for r in manifest.changed_files(hashes, known).collect()]

    rf.write(raw_dir, "2024-01-06", PAYMENTS.name, [two])  # same content, new time
    assert changed() == []
    rf.write(raw_dir, "2024-01-05", PAYMENTS.name, [one])
    paths = changed()
    assert len(paths) == 1 and "2024-01-05" in paths[0]
    (report,) = landing.land_files(spark, tables, raw_dir, paths)
    assert (report.rows, report.files) == (1, 1)
    # Dates of the former rows count as touched too.
    assert report.event_dates == {date(2024, 1, 5), date(2024, 1, 6)}
    raw = landing.read_raw(tables, PAYMENTS.name)
    assert sorted((str(r["extract_date"]), r["contract_id"]) for r in raw.collect()) == [
        ("2024-01-05", "1"),
        ("2024-01-06", "2"),
    ]


def test_file_not_written_since_is_not_read(spark, folder):
    rf.write(folder, "2024-01-05", PAYMENTS.name, [rf.payment(1, "2024-01-05 10:00:00", 5)])
    known = spark.createDataFrame(
        [(*r[:3], "known") for r in manifest.file_hashes(spark, folder).collect()],
        "path string, length bigint, modificationTime timestamp, md5 string",
    )
    assert [r["md5"] for r in manifest.file_hashes(spark, folder, known).collect()] == ["known"]
    rf.write(folder, "2024-01-05", PAYMENTS.name, [rf.payment(1, "2024-01-05 10:00:00", 50)])
    (row,) = manifest.file_hashes(spark, folder, known).collect()
    assert row["md5"] != "known"


def digest_of(spark, folder, text, split=None):
    rf.write_text(f"{folder}/2024-01-05/{PAYMENTS.name}.csv", "")
    with open(rf.local(f"{folder}/2024-01-05/{PAYMENTS.name}.csv"), "w", newline="") as f:
        f.write(text)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        (row,) = manifest.file_hashes(spark, folder).collect()
        return row["md5"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_split_digests_merge(spark):
    """However lines are dealt to splits and splits to tasks, the digest is that of the whole file."""
    import random

    lines = [f"line {i % 5}" for i in range(300)] + ["", "\r", "line 1\r"]

    def digest(cuts, offset):
        rows = [
            ("f", start, (task << 33) + offset + i, text)
            for task, (start, end) in enumerate(zip([0, *cuts], [*cuts, len(lines)], strict=True))
            for i, text in enumerate(lines[start:end])
        ]
        random.Random(offset).shuffle(rows)
        df = spark.createDataFrame(rows, "file string, start bigint, place bigint, value string")
        return manifest.line_digests(df)

    whole = digest([], 0)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    wanted = {tuple(r) for r in whole.collect()}
    for cuts, offset in (([1], 0), ([7, 8, 150], 90_000), ([100, 200], 2**32 + 5)):
        assert {tuple(r) for r in digest(cuts, offset).collect()} == wanted
    lines[3], lines[4] = lines[4], lines[3]
    assert {tuple(r) for r in digest([100], 0).collect()} != wanted


def test_digest_notices_order_and_line_ends_but_not_splits(spark, folder):
    text = '1,"a\nb"\n2,c\n2,c\n1,"a\n'
    digest = digest_of(spark, folder, text)
    assert digest_of(spark, folder, text, split=5) == digest
    others = ['2,c\n1,"a\nb"\n2,c\n1,"a\n', text.replace("\n", "\r\n"), text[:-1] + "b", text.replace("2,c\n", "", 1), "\n"]
    assert len({digest, *(digest_of(spark, folder, t, split=7) for t in others)}) == 1 + len(others)


def test_removed_files(spark, folder):
    for n in (1, 2):
        rf.write(folder, f"2024-01-0{n}", PAYMENTS.name, [rf.payment(n, "2024-01-05 10:00:00", 5)])
    tables = Tables(spark, f"{folder}/out")
    known = manifest.file_hashes(spark, folder)
    manifest.remember(tables, known)
    landing.land_files(spark, tables, folder, [r["path"] for r in known.collect()])
    known = manifest.known_files(tables)
    os.remove(rf.local(f"{folder}/2024-01-02/{PAYMENTS.name}.csv"))
    gone = manifest.removed_files(manifest.file_hashes(spark, folder, known), known)
    (path,) = [r["path"] for r in gone.collect()]
    (report,) = landing.land_files(spark, tables, folder, [path])
    assert (report.files, report.rows, report.event_dates) == (0, 0, {date(2024, 1, 5)})
    assert [r["contract_id"] for r in landing.read_raw(tables, PAYMENTS.name).collect()] == ["1"]


def test_replace_partitions(spark, folder):
    tables = Tables(spark, folder)

    def rows(*pairs):
        return spark.createDataFrame(pairs, "d string, v int").selectExpr(
            "cast(d as date) as d", "v"
        )

    def scope(p):
        return p["d"] is None or p["d"] >= "2024-01-02"

    tables.replace_partitions(
        rows(("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), (None, 4)),
        "s", "t", ["d"], scope,
    )
    written = tables.replace_partitions(rows(("2024-01-03", 30)), "s", "t", ["d"], scope)
    assert written == 1
    assert sorted((str(r["d"]), r["v"]) for r in tables.read("s", "t").collect()) == [
        ("2024-01-01", 1),
        ("2024-01-03", 30),
    ]
    assert tables.dates("s", "t", "d") == {date(2024, 1, 1), date(2024, 1, 3)}


def test_served_under_its_schema_name(spark, folder):
    tables = Tables(spark, folder)
    tables.overwrite(spark.sql("select date '2024-01-01' d, 1 v"), "test_marts", "t", ["d"])
    assert tables.register("test_marts", "t").count() == 1
    assert spark.sql("select v from test_marts.t").head()[0] == 1


def test_a_table_elsewhere_is_left_alone(spark, folder):
    tables = Tables(spark, folder)
    tables.overwrite(spark.sql("select 1 v"), "test_marts", "mine")
    spark.sql("CREATE DATABASE IF NOT EXISTS test_marts")
    spark.sql(f"CREATE TABLE test_marts.mine USING parquet LOCATION '{folder}/other' AS SELECT 7 v")
    with pytest.raises(ValueError, match="already exists at"):
        tables.register("test_marts", "mine")
    assert spark.table("test_marts.mine").head()[0] == 7
    spark.sql("DROP TABLE test_marts.mine")


def test_registered_again_it_shows_new_partitions(spark, folder):
    tables = Tables(spark, folder)
    for days in ("01", "02"), ("02", "03"):
        rows = spark.createDataFrame([(f"2024-01-{d}", int(d)) for d in days], "d string, v int")
        tables.overwrite(rows.selectExpr("v", "cast(d as date) as d"), "test_marts", "again", ["d"])
        found = tables.register("test_marts", "again")
        assert sorted(r["v"] for r in found.collect()) == [int(d) for d in days]


def raw_calls(spark, folder, body):
    path = rf.write(folder, "2024-01-05", CALLS.name, [])
    with open(path, "a", newline="") as f:
        f.write(body)
    return {r["ch_call_id"]: r["udh_notes"] for r in read_calls(spark, folder).collect()}


def test_quotes_and_line_ends_of_calls(spark, folder):
    def line(key, note, end):
        return f"{key},2024-01-05 10:00:00,1,done,out,1,u,camp,{note}{end}"

    got = raw_calls(spark, folder, line(1, '5" pipe', "\r\n") + line(2, '"a ""b"" c"', "\r\n") + line(3, '"x\ny"', "\r\n"))
    assert got == {"1": '5" pipe', "2": 'a "b" c', "3": "x\ny"}
    # Spark's reader gives a line end inside a quoted value as a line feed.
    assert raw_calls(spark, folder, line(1, '"a\r\nb"', "\r\n")) == {"1": "a\nb"}


def test_entities_without_line_ends_are_read_in_splits(spark, folder):
    rows = [rf.payment(i, "2024-01-05 10:00:00", i) for i in range(60)]
    rf.write(folder, "2024-01-05", PAYMENTS.name, rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = landing.read_extracts(spark, PAYMENTS, landing.extract_files(spark, folder, PAYMENTS))
        assert df.rdd.getNumPartitions() > 3
        assert {r["contract_id"] for r in df.collect()} == {str(i) for i in range(60)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_record_broken_over_lines_fails_where_none_may_be(spark, folder):
    path = rf.write(folder, "2024-01-05", PAYMENTS.name, [])
    with open(path, "a") as f:
        f.write('2024-01-05 10:00:00,1001,1,"MP\nESA",p,5\n')
    raw = landing.read_extracts(spark, PAYMENTS, landing.extract_files(spark, folder, PAYMENTS))
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.collect()


def test_lineage_is_cut_without_patterns(spark, folder):
    """One file or a folder of parts; a pattern per row took longer than reading it."""
    entity = schemas.ENTITIES[schemas.PAYMENTS]
    rows = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in entity.columns])
    rows.coalesce(1).write.option("header", True).csv(f"{folder}/raw/2024-01-01/{entity.file_name}")
    part = next(iter(landing.extract_files(spark, f"{folder}/raw", entity)))
    os.makedirs(f"{folder}/raw/2024-01-02")
    shutil.copy(part.removeprefix("file:"), f"{folder}/raw/2024-01-02/{entity.file_name}")
    found = landing.read_extracts(spark, entity, landing.extract_files(spark, f"{folder}/raw", entity))
    lineage = {(r._source_file, r.extract_date) for r in found.collect()}
    name = entity.file_name
    assert lineage == {
        (f"raw/2024-01-01/{name}/{part.rsplit('/', 1)[1]}", "2024-01-01"),
        (f"raw/2024-01-02/{name}", "2024-01-02"),
    }
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()
