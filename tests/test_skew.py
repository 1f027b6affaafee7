import pytest
from pyspark.sql import functions as F

from callscope.operators import skew
from callscope.operators.coding import match_calls, unmatched_notes


def test_heavy_keys_counts_and_ignores_null(spark):
    df = spark.sql(
        "select 1L k from range(5) union all select 2L from range(3) "
        "union all select 3L from range(1) union all select null from range(9)"
    )
    assert dict(map(tuple, skew.heavy_keys(df, F.col("k"), 2).collect())) == {1: 5, 2: 3}
    assert skew.heavy_keys(df, F.col("k"), 5).isEmpty()


def test_every_heavy_key_is_found(spark):
    many = spark.range(3 * 5000).selectExpr("id % 5000 as k")
    assert skew.heavy_keys(many, F.col("k"), 2).count() == 5000


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).selectExpr(
        "id as row", "case id % 4 when 0 then 7L when 1 then null else id % 50 end as k"
    )
    right = spark.range(-2000, 40).selectExpr("id as r", "id * 10 as v")
    for how in ("left", "left_anti"):
        plain = left.join(right, F.col("k") == F.col("r"), how)
        expected = sorted(map(tuple, plain.collect()), key=repr)
        for split_rows in (100, 10**9):
            salted = skew.salted_join(left, right, "k", "r", "row", how, split_rows)
            assert salted.columns == plain.columns
            assert sorted(map(tuple, salted.collect()), key=repr) == expected


@pytest.mark.parametrize("key", ["7L", "cast(null as bigint)"])
def test_heavy_or_missing_key_is_spread(spark, key):
    """With 1000 rows and 100 per part, the one key lands in several partitions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(1000).selectExpr("id as row", f"{key} as k")
        right = spark.range(20).selectExpr("id as r")
        joined = skew.salted_join(left, right, "k", "r", "row", split_rows=100)
        tasks = joined.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_coding_with_blank_and_repeated_notes(spark):
    notes = [None, "5", "5\n", "05", "6", "text", "9" * 20, "5", "5"]
    calls = spark.createDataFrame(
        [(i, None, "Kenya", "out", 0, "u", "c", n) for i, n in enumerate(notes)],
        "call_id bigint, called_at_local timestamp_ntz, market string, call_type string, "
        "talk_time_ms bigint, ameyo_user_id string, campaign_name string, call_notes_raw string",
    )
    dispositions = spark.createDataFrame(
        [(5, 50, None)], "call_log_id bigint, contract_id bigint, disposed_at_utc timestamp_ntz"
    )
    for split_rows in (10**9, 2):
        rows = match_calls(calls, dispositions, split_rows).collect()
        assert len(rows) == len(notes)
        assert {r["call_id"] for r in rows if r["is_coded"]} == {1, 2, 3, 7, 8}
        assert {r["matched_contract_id"] for r in rows if r["is_coded"]} == {50}
        missing = unmatched_notes(calls, dispositions, split_rows).collect()
        assert [r["call_id"] for r in missing] == [4]
