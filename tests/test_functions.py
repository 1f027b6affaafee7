import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from callscope import functions as fn
from callscope.functions.keys import NULL_MARKER


def column(spark, values, type_, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_note_to_id(spark):
    cases = {
        None: None,
        "": None,
        "   ": None,
        "123": 123,
        "123\n": 123,
        "\t 123 \r\n": 123,
        "12\n34": None,
        "007": 7,
        "text": None,
        "12a": None,
        "-5": None,
        "9223372036854775807": 9223372036854775807,
        "9" * 20: None,
        "123\v": None,
        "\u0661\u0662": None,
    }
    assert column(spark, cases, "string", fn.note_to_id) == list(cases.values())


def test_blank_to_null_strips_space_separators_only(spark):
    values = [None, "", "  ", " a ", "\u00a0a\u2003", "\n", "\ta"]
    assert column(spark, values, "string", fn.blank_to_null) == [
        None,
        None,
        None,
        "a",
        "a",
        "\n",
        "\ta",
    ]


def test_labels_of_unknown_codes_are_null(spark):
    labels = column(
        spark, [1, 2, 3, 4, 5, None], "int", lambda c: fn.label(c, fn.MARKET_BY_CENTRE)
    )
    assert labels == ["Kenya", "Uganda", "Tanzania", "Nigeria", None, None]
    currencies = column(spark, [1001, 1004, 9], "int", lambda c: fn.label(c, fn.CURRENCY_BY_TENANT))
    assert currencies == ["KES", "NGN", None]


def test_plain_number(spark):
    values = [10.0, 10.5, 1e7, 123456789.125, 0.03000000000000025, 100.0, None, 1e30]
    assert column(spark, values, "double", fn.plain_number) == [
        "10.0",
        "10.5",
        "10000000.0",
        "123456789.125",
        "0.03000000000000025",
        "100.0",
        None,
        "1.0E30",
    ]


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([(1, None, date(2024, 1, 2))], "a int, b string, c date")
    key = df.select(fn.surrogate_key(F.col("a"), F.col("b"), F.col("c"))).head()[0]
    assert key == hashlib.md5(f"1-{NULL_MARKER}-2024-01-02".encode()).hexdigest()


def test_times_ignore_the_session_zone(spark):
    """02:30 does not exist on this day in New York."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz '2024-03-10 02:30:15.5' as t")
        row = df.select(fn.window_close(F.col("t")).alias("w")).head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["w"] == datetime(2024, 3, 13, 2, 30, 15, 500000)
