"""Queries about landing files, exchange rates and serving."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope import fixtures as fx
from callscope import schemas
from callscope.functions import plus_days
from callscope.operators import quality
from callscope.operators.rates import latest_rates
from callscope.plans import daily, marts, sketches, staging
from callscope.queries import ctes, deliveries, models
from callscope.queries.registry import query, with_ctes
from callscope.session import shared_folder
from callscope.sources import fx as fx_source
from callscope.sources import key_index, landing, manifest
from callscope.sources.tables import Tables
from callscope.streaming.ingest import ingest_stream

DAY_ONE, DAY_TWO = date(2024, 1, 16), date(2024, 1, 31)

# Which rows arrive first; the rest arrives on the second day.
_EARLY = {
    schemas.CALLS: "ch_date_added < timestamp_ntz '1996-01-01'",
    schemas.DISPOSITIONS: "created_timestamp_utc < timestamp_ntz '2024-01-16'",
    schemas.PAYMENTS: "pay_timestamp_utc < timestamp_ntz '2024-01-16'",
    schemas.AGENT_MAPPING: "team < 'F'",
}
_LATE = {entity: f"coalesce(not ({early}), true)" for entity, early in _EARLY.items()}


def _folder(spark: SparkSession, name: str) -> tuple[str, Tables]:
    base = shared_folder(spark, name)
    return f"{base}/raw", Tables(spark, f"{base}/out")


def _deliver_both(spark: SparkSession, sf_dir: str, raw_dir: str, *entities: str) -> None:
    for day, parts, reorder in ((DAY_ONE, _EARLY, False), (DAY_TWO, _LATE, True)):
        deliveries.deliver(
            spark, sf_dir, raw_dir, day, {e: parts[e] for e in entities or parts}, reorder
        )


_LANDED_CALLS_SQL = with_ctes(
    fx.CALLS_SQL,
    select="""
    SELECT ch_call_id::VARCHAR AS ch_call_id, ch_date_added::VARCHAR AS ch_date_added,
           ch_contact_center_id::VARCHAR AS ch_contact_center_id, ch_system_disposition,
           ch_call_type, total_talk_time::VARCHAR AS total_talk_time, udh_user_id,
           campaign_name, udh_notes,
           'raw/' || CASE WHEN ch_date_added < TIMESTAMP '1996-01-01' THEN '2024-01-16'
                          ELSE '2024-01-31' END || '/ameyo_outbound_calls.csv' AS _source_file
    FROM raw_calls""",
)


@query("s1_landed_calls", _LANDED_CALLS_SQL)
def landed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of files, the second with other column order and one column more."""
    raw_dir, _ = _folder(spark, "landed-calls")
    _deliver_both(spark, sf_dir, raw_dir, schemas.CALLS)
    entity = schemas.ENTITIES[schemas.CALLS]
    files = landing.extract_files(spark, raw_dir, entity)
    return landing.read_extracts(spark, entity, files).select(
        *entity.columns, F.regexp_replace("_source_file", r"/part-[^/]*$", "").alias("_source_file")
    )


@query(
    "s9_s10_rows_loaded",
    """
    SELECT 'ameyo_outbound_calls' AS table_name, count(*) AS rows_loaded FROM orders
    UNION ALL
    SELECT 'atlas_calls_dispositions', count(*) FROM events WHERE event_type <> 'purchase'
    UNION ALL
    SELECT 'atlas_payments', count(*) FROM events WHERE event_type = 'purchase'
    UNION ALL
    SELECT 'atlas_ameyo_mapping', count(*) FROM customer""",
)
def rows_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_dir, tables = _folder(spark, "rows-loaded")
    _deliver_both(spark, sf_dir, raw_dir)
    report = landing.land_all(spark, tables, raw_dir)
    return spark.createDataFrame(
        [(r.table, r.rows) for r in report], "table_name string, rows_loaded bigint"
    )


@query(
    "s11_streamed_payments",
    with_ctes(*ctes.PAYMENTS, select="SELECT * FROM stg_payments"),
)
def streamed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's files are landed by the stream run after their arrival, once."""
    raw_dir, tables = _folder(spark, "streamed")
    for day, parts in ((DAY_ONE, _EARLY), (DAY_TWO, _LATE)):
        deliveries.deliver(
            spark, sf_dir, raw_dir, day, {schemas.PAYMENTS: parts[schemas.PAYMENTS]}
        )
        ingest_stream(spark, raw_dir, tables.root, f"{tables.root}/checkpoint").awaitTermination()
    return staging.stg_payments(landing.read_raw(tables, schemas.PAYMENTS)).drop(*schemas.LINEAGE)


@query(
    "s12_changed_files_landed",
    """
    SELECT 'atlas_payments' AS table_name, count(*) AS rows_loaded FROM events
    WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-16'
    UNION ALL
    SELECT 'atlas_calls_dispositions', count(*) FROM events
    WHERE event_type <> 'purchase' AND date_trunc('hour', ts) >= TIMESTAMP '2024-01-16'
    """,
)
def changed_files_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all files present only those the manifest does not know are landed."""
    raw_dir, tables = _folder(spark, "changed")
    entities = (schemas.PAYMENTS, schemas.DISPOSITIONS)
    deliveries.deliver(spark, sf_dir, raw_dir, DAY_ONE, {e: _EARLY[e] for e in entities})
    manifest.remember(tables, manifest.file_hashes(spark, raw_dir))
    deliveries.deliver(spark, sf_dir, raw_dir, DAY_TWO, {e: _LATE[e] for e in entities})
    known = manifest.known_files(tables)
    changed = manifest.changed_files(manifest.file_hashes(spark, raw_dir, known), known)
    report = landing.land_files(
        spark, tables, raw_dir, [r["path"] for r in changed.select("path").collect()]
    )
    return spark.createDataFrame(
        [(r.table, r.rows) for r in report], "table_name string, rows_loaded bigint"
    )


@query(
    "d1_duplicates_of_an_extract",
    with_ctes(
        fx.DISPOSITIONS_SQL,
        select="""
        SELECT call_log_id::VARCHAR AS call_log_id, count(*) + 1 AS n FROM raw_dispositions
        WHERE call_log_id % 50 = 0 GROUP BY call_log_id""",
    ),
)
def duplicates_of_an_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day delivers some dispositions again; the key index finds them."""
    raw_dir, tables = _folder(spark, "duplicates")
    name = schemas.DISPOSITIONS
    paths = [f"{raw_dir}/{day}/{name}.csv" for day in (DAY_ONE, DAY_TWO)]
    deliveries.deliver(spark, sf_dir, raw_dir, DAY_ONE, {name: "true"})
    landing.land_files(spark, tables, raw_dir, paths[:1])
    deliveries.deliver(spark, sf_dir, raw_dir, DAY_TWO, {name: "call_log_id % 50 = 0"})
    landed = landing.land_files(spark, tables, raw_dir, paths[1:])
    days = {day for load in landed for day in load.days}
    rows = key_index.sharing_keys(tables, name, days).withColumnRenamed(key_index.KEY, "call_log_id")
    return quality.unique(name, rows, "call_log_id").violations


def _sketched(spark: SparkSession, sf_dir: str, *entities: str) -> list[DataFrame]:
    """Sketches of two extracts each, landed one after the other."""
    raw_dir, tables = _folder(spark, "sketches")
    _deliver_both(spark, sf_dir, raw_dir, *entities)
    for day in (DAY_ONE, DAY_TWO):
        landed = landing.land_files(spark, tables, raw_dir, [f"{raw_dir}/{day}/{e}.csv" for e in entities])
        for load in landed:
            sketches.update(tables, load.table, load.days)
    return [sketches.of_extracts(tables, e) for e in entities]


@query(
    "g2_note_ids_of_sketches",
    with_ctes(
        *ctes.ALL_CODED,
        select="""
        SELECT count(call_notes_raw) AS notes,
               count(*) FILTER (call_notes_raw IS NOT NULL AND candidate_call_log_id IS NULL) AS not_an_id,
               count(DISTINCT candidate_call_log_id) AS ids_named,
               count(DISTINCT candidate_call_log_id) FILTER (is_coded) AS ids_matched
        FROM coded""",
    ),
)
def note_ids_of_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged from sketches per extract; equal to the SQL up to 65,536 different ids, close beyond."""
    return sketches.note_ids(*_sketched(spark, sf_dir, schemas.CALLS, schemas.DISPOSITIONS))


@query(
    "g6_g8_contracts_of_sketches",
    with_ctes(
        *ctes.DISPOSITIONS,
        *ctes.PAYMENTS,
        """
        loads AS (SELECT contract_id, count(*) AS n, count(DISTINCT disposed_at_utc) AS moments
                  FROM stg_dispositions WHERE contract_id IS NOT NULL GROUP BY 1),
        paid AS (SELECT DISTINCT contract_id FROM stg_payments WHERE contract_id IS NOT NULL)""",
        select="""
        SELECT count(*) AS called, (SELECT count(*) FROM paid) AS paying,
               count(*) FILTER (contract_id IN (FROM paid)) AS called_and_paying,
               sum(n - moments)::BIGINT AS tied_rows, max(n) AS most_dispositions
        FROM loads""",
    ),
)
def contracts_of_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged from sketches per extract; equal to the SQL up to 65,536 different values, close beyond."""
    return sketches.contract_load(*_sketched(spark, sf_dir, schemas.DISPOSITIONS, schemas.PAYMENTS))


@query(
    "s5_lineage_of_payments",
    """
    SELECT 'ingestion' AS loaded_by, count(*) AS rows_loaded, count(DISTINCT day) AS extracts FROM (
      SELECT ts < TIMESTAMP '2024-01-16' AS day FROM events WHERE event_type = 'purchase')""",
)
def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payments carry one shape of lineage: the file and the time of loading."""
    raw_dir, tables = _folder(spark, "lineage")
    _deliver_both(spark, sf_dir, raw_dir, schemas.PAYMENTS)
    entity = schemas.ENTITIES[schemas.PAYMENTS]
    raw = landing.read_extracts(spark, entity, landing.extract_files(spark, raw_dir, entity))
    loaded = staging.unify_lineage(raw).where(" AND ".join(f"{c} IS NOT NULL" for c in schemas.LINEAGE))
    folder = F.regexp_extract("_source_file", r"raw/([^/]+)/", 1)
    return loaded.agg(F.count("*").alias("rows_loaded"), F.count_distinct(folder).alias("extracts")).select(
        F.lit("ingestion").alias("loaded_by"), "rows_loaded", "extracts"
    )


@query(
    "s8_missing_extracts",
    """
    SELECT 'atlas_payments' AS table_name, count(*) > 0 AS refused FROM events WHERE event_type = 'purchase'""",
)
def missing_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one entity not delivered the load fails and names it; the payments are the one left out."""
    raw_dir, tables = _folder(spark, "missing")
    _deliver_both(spark, sf_dir, raw_dir, *(e for e in _EARLY if e != schemas.PAYMENTS))
    try:
        landing.land_all(spark, tables, raw_dir)
        refused = ""
    except landing.MissingExtract as error:
        refused = str(error)
    return spark.createDataFrame(
        [(schemas.PAYMENTS, schemas.PAYMENTS in refused)], "table_name string, refused boolean"
    )


def fx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_source.rate_rows(
        fx.fx_payloads(spark, sf_dir),
        F.col("rate_date"),
        F.col("rate_date").cast("timestamp_ntz"),
    )


@query(
    "s13_fx_payload_rates",
    with_ctes(
        fx.FX_HISTORY_SQL,
        select="""
        SELECT rate_date, currency, local_units_per_usd, rate_date::TIMESTAMP AS fetched_at,
               'exchangerate-api.com' AS source FROM raw_fx""",
    ),
)
def fx_payload_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_history(spark, sf_dir)


@query(
    "s15_fx_upsert",
    with_ctes(
        fx.FX_HISTORY_SQL,
        select="""
        SELECT rate_date, currency,
               CASE WHEN rate_date >= DATE '2024-01-20' THEN 2 * local_units_per_usd
                    ELSE local_units_per_usd END AS local_units_per_usd,
               rate_date::TIMESTAMP AS fetched_at
        FROM raw_fx""",
    ),
)
def fx_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the later dates again, at twice the rate, replaces them and leaves the others."""
    _, tables = _folder(spark, "fx")
    history = fx_history(spark, sf_dir)
    fx_source.upsert_rates(tables, history)
    again = history.filter(F.col("rate_date") >= F.lit(date(2024, 1, 20)))
    fx_source.upsert_rates(
        tables, again.withColumn("local_units_per_usd", F.col("local_units_per_usd") * 2)
    )
    return staging.stg_fx_rates(fx_source.read_rates(tables))


# Every date is fetched on its day, and from the twentieth on again two days later at twice the rate.
_VERSIONS_SQL = """
versions AS (
  SELECT rate_date, currency, local_units_per_usd, rate_date::TIMESTAMP AS fetched_at FROM raw_fx
  UNION ALL
  SELECT rate_date, currency, 2 * local_units_per_usd, rate_date::TIMESTAMP + INTERVAL 2 DAY
  FROM raw_fx WHERE rate_date >= DATE '2024-01-20'),
known AS (
  SELECT rate_date, currency, arg_max(local_units_per_usd, fetched_at) AS local_units_per_usd,
         max(fetched_at) AS fetched_at
  FROM versions WHERE fetched_at <= TIMESTAMP '2024-01-24 00:00:00' GROUP BY rate_date, currency)
"""
_KNOWN_AT = datetime(2024, 1, 24)


def _fetched_twice(spark: SparkSession, sf_dir: str) -> Tables:
    _, tables = _folder(spark, "fx-versions")
    history = fx_history(spark, sf_dir)
    fx_source.upsert_rates(tables, history)
    again = history.filter(F.col("rate_date") >= F.lit(date(2024, 1, 20)))
    later = {
        "local_units_per_usd": F.col("local_units_per_usd") * 2,
        "fetched_at": plus_days(F.col("fetched_at"), 2),
    }
    fx_source.upsert_rates(tables, again.withColumns(later))
    return tables


@query(
    "s15_rates_as_known",
    with_ctes(fx.FX_HISTORY_SQL, _VERSIONS_SQL, select="SELECT * FROM known"),
)
def rates_as_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as it was known on a day, after later fetches have replaced rates."""
    return staging.stg_fx_rates(fx_source.read_rates(_fetched_twice(spark, sf_dir), _KNOWN_AT))


@query(
    "g9_value_as_known",
    with_ctes(
        *ctes.ALL_ATTRIBUTION,
        fx.FX_HISTORY_SQL,
        _VERSIONS_SQL,
        """paid_days AS (
          SELECT DISTINCT pay_timestamp_utc::DATE AS call_date, currency FROM attribution
          WHERE is_paid_post_call)""",
        """nearest AS (
          SELECT call_date, p.currency,
                 arg_min(struct_pack(d := rate_date, r := local_units_per_usd),
                         abs(call_date - rate_date) * 2 + (rate_date > call_date)::INTEGER) AS pick
          FROM paid_days p JOIN known k ON p.currency = k.currency GROUP BY ALL)""",
        select="""
        SELECT call_date, market, max(pick.d) AS fx_rate_date_used,
               round(sum(amount_local / pick.r), 4) AS value_recovered_usd
        FROM attribution a JOIN nearest n
          ON n.call_date = a.pay_timestamp_utc::DATE AND n.currency = a.currency
        WHERE is_paid_post_call GROUP BY ALL""",
    ),
)
def value_as_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value at the rate nearest to each payment, of the rates known on a day."""
    rates = fx_source.read_rates(_fetched_twice(spark, sf_dir), _KNOWN_AT)
    value = marts.fct_value_recovered_usd(models.attribution(spark, sf_dir), rates, "nearest")
    return models.money(value, "value_recovered_usd").drop("value_recovered_id")


@query(
    "stg_fx_rates",
    with_ctes(
        fx.FX_HISTORY_SQL,
        select="""
        SELECT rate_date, currency, local_units_per_usd, rate_date::TIMESTAMP AS fetched_at
        FROM raw_fx""",
    ),
)
def stg_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_fx_rates(fx_history(spark, sf_dir))


@query(
    "w3_latest_rate_per_currency",
    with_ctes(
        fx.FX_HISTORY_SQL,
        select="""
        SELECT currency, max(rate_date) AS rate_date,
               arg_max(local_units_per_usd, rate_date) AS local_units_per_usd
        FROM raw_fx GROUP BY currency""",
    ),
)
def w3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rates(fx_history(spark, sf_dir))


@query(
    "g9_value_at_nearest_rate",
    with_ctes(
        *ctes.ALL_ATTRIBUTION,
        fx.FX_HISTORY_SQL,
        """
        needed AS (
          SELECT DISTINCT pay_timestamp_utc::DATE AS pay_date, currency
          FROM attribution WHERE is_paid_post_call),
        nearest AS (
          SELECT DISTINCT ON (n.pay_date, n.currency)
                 n.pay_date, n.currency, f.rate_date, f.local_units_per_usd AS rate
          FROM needed n LEFT JOIN raw_fx f USING (currency)
          ORDER BY n.pay_date, n.currency, abs(n.pay_date - f.rate_date), f.rate_date)""",
        select="""
        SELECT pay_date AS call_date, market, max(rate_date) AS fx_rate_date_used,
               round(sum(amount_local / rate), 4) AS value_recovered_usd
        FROM attribution a JOIN nearest n
          ON n.pay_date = a.pay_timestamp_utc::DATE AND n.currency IS NOT DISTINCT FROM a.currency
        GROUP BY ALL""",
    ),
)
def g9(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = marts.fct_value_recovered_usd(
        models.attribution(spark, sf_dir), fx_history(spark, sf_dir), fx="nearest"
    )
    return models.money(value.drop("value_recovered_id"), "value_recovered_usd")


@query(
    "s17_s18_served_drivers",
    with_ctes(*ctes.ALL_DRIVERS, select="SELECT * FROM fct_drivers"),
)
def served_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written as partitioned Parquet and read back by its schema-qualified name."""
    _, tables = _folder(spark, "served")
    tables.overwrite(models.inbound_drivers(spark, sf_dir), *daily.DRIVERS, [daily.CALL_DATE])
    database = f"served_{uuid.uuid4().hex}"
    tables.register(*daily.DRIVERS, database)
    return spark.sql(f"SELECT * FROM {database}.fct_inbound_call_drivers")
