"""The call-centre raw tables, reshaped from the generic test tables.

Each table is given twice, as a DataFrame and as DuckDB SQL, from the same rule. Codes outside the
label maps, blank and malformed notes, ties, null contracts and bad amounts all occur.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 31)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def start_of_hour(at):
    """Truncate a naive timestamp without going through the session time zone."""
    return at - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(at), F.extract(F.lit("SECOND"), at)
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    pasted = (key % 10000).cast("string")
    note = reduce(
        lambda chain, case: chain.when(key % 8 == case[0], case[1]),
        [
            (1, F.lit("   ")),
            (2, F.concat(pasted, F.lit("\n"))),
            (3, F.lit("no answer")),
            (4, F.lit("12\n34")),
            (5, F.lit("9" * 20)),
            (6, F.concat(F.lit("00"), pasted)),
            (7, pasted),
        ],
        F.when(key % 8 == 0, F.lit(None).cast("string")),
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("ch_call_id"),
        F.trunc(F.to_date("o_orderdate"), "month").cast("timestamp_ntz").alias("ch_date_added"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("ch_contact_center_id"),
        F.col("o_orderstatus").alias("ch_system_disposition"),
        F.lit("outbound").alias("ch_call_type"),
        (key % 600 * 1000).alias("total_talk_time"),
        (F.col("o_custkey") % 20).cast("string").alias("udh_user_id"),
        F.col("o_orderpriority").alias("campaign_name"),
        note.alias("udh_notes"),
    )


CALLS_SQL = r"""
raw_calls AS (
  SELECT o_orderkey AS ch_call_id,
         date_trunc('month', o_orderdate)::TIMESTAMP AS ch_date_added,
         (o_custkey % 5 + 1)::INTEGER AS ch_contact_center_id,
         o_orderstatus AS ch_system_disposition,
         'outbound' AS ch_call_type,
         o_orderkey % 600 * 1000 AS total_talk_time,
         (o_custkey % 20)::VARCHAR AS udh_user_id,
         o_orderpriority AS campaign_name,
         CASE o_orderkey % 8
           WHEN 1 THEN '   '
           WHEN 2 THEN (o_orderkey % 10000)::VARCHAR || chr(10)
           WHEN 3 THEN 'no answer'
           WHEN 4 THEN '12' || chr(10) || '34'
           WHEN 5 THEN repeat('9', 20)
           WHEN 6 THEN '00' || (o_orderkey % 10000)::VARCHAR
           WHEN 7 THEN (o_orderkey % 10000)::VARCHAR
         END AS udh_notes
  FROM orders)
"""


def dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    team = (
        F.when(F.col("event_type") == "signup", "Inbound Team")
        .when(F.col("event_type") == "view", "Phone Call")
        .when(F.col("event_type") == "click", "Upsell Team")
    )
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") != "purchase")
        .select(
            key.alias("call_log_id"),
            (F.col("user_id") % 5 + 1001).cast("int").alias("tenant_id"),
            F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("customer_id"),
            F.when(key % 8 != 0, F.col("user_id")).alias("contract_id"),
            start_of_hour(F.col("ts")).alias("created_timestamp_utc"),
            F.concat(F.lit("agent"), (key % 18).cast("string")).alias("createdby"),
            team.alias("call_type"),
            F.concat(F.lit("L1_"), (key % 4).cast("string")).alias("level_one"),
            F.when(key % 5 == 0, "  ")
            .otherwise(F.concat(F.lit("L2_"), (key % 3).cast("string")))
            .alias("level_two"),
            F.when(key % 7 == 0, "")
            .otherwise(F.concat(F.lit("L3_"), (key % 2).cast("string")))
            .alias("level_three"),
        )
    )


DISPOSITIONS_SQL = """
raw_dispositions AS (
  SELECT event_id AS call_log_id,
         (user_id % 5 + 1001)::INTEGER AS tenant_id,
         'c' || user_id::VARCHAR AS customer_id,
         CASE WHEN event_id % 8 <> 0 THEN user_id END AS contract_id,
         date_trunc('hour', ts) AS created_timestamp_utc,
         'agent' || (event_id % 18)::VARCHAR AS createdby,
         CASE event_type WHEN 'signup' THEN 'Inbound Team' WHEN 'view' THEN 'Phone Call'
                         WHEN 'click' THEN 'Upsell Team' END AS call_type,
         'L1_' || (event_id % 4)::VARCHAR AS level_one,
         CASE WHEN event_id % 5 = 0 THEN '  '
              ELSE 'L2_' || (event_id % 3)::VARCHAR END AS level_two,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE 'L3_' || (event_id % 2)::VARCHAR END AS level_three
  FROM events WHERE event_type <> 'purchase')
"""


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    provider = (
        F.when(key % 10 == 0, "MANUAL").when(key % 10 == 1, " MPESA ").otherwise("MPESA")
    )
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("ts").alias("pay_timestamp_utc"),
            (F.col("user_id") % 4 + 1001).cast("int").alias("tenant_id"),
            F.col("user_id").alias("contract_id"),
            provider.alias("payment_request_provider"),
            F.lit("program").alias("create_program"),
            (F.col("value") - 5.0).alias("amount"),
        )
    )


PAYMENTS_SQL = """
raw_payments AS (
  SELECT ts AS pay_timestamp_utc,
         (user_id % 4 + 1001)::INTEGER AS tenant_id,
         user_id AS contract_id,
         CASE event_id % 10 WHEN 0 THEN 'MANUAL' WHEN 1 THEN ' MPESA ' ELSE 'MPESA' END
           AS payment_request_provider,
         'program' AS create_program,
         value - 5.0 AS amount
  FROM events WHERE event_type = 'purchase')
"""


def agent_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins 18 and 19 of the calls are not mapped."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("centre"), (F.col("c_nationkey") % 4).cast("string")).alias(
            "contact_centre"
        ),
        (F.col("c_custkey") % 18).cast("string").alias("ameyo_user_id"),
        F.col("c_mktsegment").alias("team"),
        F.col("c_name").alias("atlas_user_name"),
    )


AGENT_MAPPING_SQL = """
raw_mapping AS (
  SELECT 'centre' || (c_nationkey % 4)::VARCHAR AS contact_centre,
         (c_custkey % 18)::VARCHAR AS ameyo_user_id,
         c_mktsegment AS team,
         c_name AS atlas_user_name
  FROM customer)
"""

_RATES = [
    (date(2024, 1, 30), "KES", 131.3),
    (date(2024, 1, 31), "KES", 133.7),
    (date(2024, 1, 31), "UGX", 3791.3),
    (date(2024, 1, 31), "TZS", 2533.9),
    (date(2024, 1, 31), "NGN", 811.7),
]


def fx_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        _RATES, "rate_date date, currency string, local_units_per_usd double"
    )


FX_RATES_SQL = """
raw_fx AS (
  SELECT * FROM (VALUES
    (DATE '2024-01-30', 'KES', 131.3::DOUBLE), (DATE '2024-01-31', 'KES', 133.7::DOUBLE),
    (DATE '2024-01-31', 'UGX', 3791.3::DOUBLE), (DATE '2024-01-31', 'TZS', 2533.9::DOUBLE),
    (DATE '2024-01-31', 'NGN', 811.7::DOUBLE)) AS t(rate_date, currency, local_units_per_usd))
"""


def fx_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API answer per working day with events; rates move with the traffic."""
    per_day = (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("rate_date"))
        .agg(F.count("*").alias("n"))
        .filter(F.weekday("rate_date") < 5)
    )
    rates = ", ".join(
        f"'{c}', cast({base} + n % {step} as double)" for c, base, step in _RATE_RULE
    )
    body = F.struct(
        F.lit("success").alias("result"), F.expr(f"map({rates})").alias("conversion_rates")
    )
    return per_day.select("rate_date", F.to_json(body).alias("payload"))


_RATE_RULE = [
    ("KES", 131, 10),
    ("UGX", 3803, 50),
    ("TZS", 2539, 40),
    ("NGN", 907, 100),
    ("USD", 1, 1),
]

FX_HISTORY_SQL = """
days AS (
  SELECT ts::DATE AS rate_date, count(*) AS n FROM events
  WHERE isodow(ts) < 6 GROUP BY 1),
raw_fx AS (
  SELECT rate_date, c.currency, (c.base + n % c.step)::DOUBLE AS local_units_per_usd
  FROM days, (VALUES ('KES', 131, 10), ('UGX', 3803, 50), ('TZS', 2539, 40), ('NGN', 907, 100))
    AS c(currency, base, step))
"""
