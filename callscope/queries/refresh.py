"""The daily job run several times over late data; its marts must equal one full build."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope import fixtures as fx
from callscope import schemas
from callscope.operators.quality import QualityError
from callscope.plans import daily, restate, rollups, states
from callscope.queries import ctes, deliveries, models
from callscope.queries.registry import query, with_ctes
from callscope.session import shared_folder
from callscope.sources.tables import Tables, write_text
from callscope.streaming import owners
from callscope.streaming.ingest import refresh_stream

_RUNS = (date(2024, 1, 12), date(2024, 1, 20), date(2024, 1, 31))
_RATES = (("USD", 1.0), ("NGN", 811.7), ("KES", 133.7), ("TZS", 2533.9), ("UGX", 3791.3))
_runs: dict[tuple[str, str, str], Tables] = {}
_changes: dict[tuple[str, str, str], DataFrame] = {}


def forget_runs() -> None:
    """Let the next query run the job again."""
    _runs.clear()
    _changes.clear()


def _deliver(spark: SparkSession, sf_dir: str, raw_dir: str, after: date, upto: date) -> None:
    def arrived(at: str, key: str) -> str:
        # Rows arrive up to two days after the event.
        day = f"date_add(to_date({at}), cast({key} % 3 as int))"
        return f"{day} > date '{after}' and {day} <= date '{upto}'"

    parts = {
        schemas.DISPOSITIONS: arrived("created_timestamp_utc", "call_log_id"),
        schemas.PAYMENTS: arrived("pay_timestamp_utc", "contract_id"),
    }
    if after < _RUNS[0]:
        parts |= {schemas.CALLS: "true", schemas.AGENT_MAPPING: "true"}
    deliveries.deliver(spark, sf_dir, raw_dir, upto, parts)


def _spans():
    return zip((date(2000, 1, 1), *_RUNS), (*_RUNS[:-1], date(2100, 1, 1)), strict=False)


def _daily(spark: SparkSession, sf_dir: str) -> Tables:
    """Three runs; the marts are kept for the other queries of this session."""
    key = ("daily", spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        base = shared_folder(spark, "daily")
        payload = f"{base}/latest.json"
        write_text(spark, payload, deliveries.payload(_RATES))
        for (after, upto), run in zip(_spans(), _RUNS, strict=True):
            _deliver(spark, sf_dir, f"{base}/raw", after, upto)
            daily.run_daily(
                spark,
                f"{base}/raw",
                f"{base}/out",
                deliveries.midnight(run),
                fx_payload=payload,
                keep_changes=[daily.PAID],
            )
        _runs[key] = Tables(spark, f"{base}/out")
    return _runs[key]


def _streamed(spark: SparkSession, sf_dir: str) -> Tables:
    key = ("streamed", spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        base = shared_folder(spark, "refresh")
        tables = Tables(spark, f"{base}/out")
        payload = f"{base}/latest.json"
        write_text(spark, payload, deliveries.payload(_RATES))
        daily.fx.load_payload(tables, payload, deliveries.midnight(_RUNS[0]))
        for (after, upto), run in zip(_spans(), _RUNS, strict=True):
            _deliver(spark, sf_dir, f"{base}/raw", after, upto)
            refresh_stream(
                spark,
                f"{base}/raw",
                tables.root,
                f"{base}/checkpoint",
                clock=lambda run=run: deliveries.midnight(run),
            ).awaitTermination()
        _runs[key] = tables
    return _runs[key]


@query("i_daily_paid_post_call", with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid"))
def daily_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).read(*daily.PAID).drop(daily.DISPOSED_DATE)


@query(
    "i_daily_payment_attribution",
    with_ctes(*ctes.ALL_ATTRIBUTION, select="SELECT * FROM attribution"),
)
def daily_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).read(*daily.ATTRIBUTION).drop(daily.DISPOSED_DATE)


@query(
    "i_daily_value_recovered_usd",
    with_ctes(
        *ctes.ALL_VALUE,
        select="SELECT call_date, market, value_recovered_usd FROM fct_value",
    ),
)
def daily_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = _daily(spark, sf_dir).read(*daily.VALUE)
    return models.money(
        value.select("call_date", "market", "value_recovered_usd"), "value_recovered_usd"
    )


@query(
    "i_daily_inbound_call_drivers",
    with_ctes(*ctes.ALL_DRIVERS, select="SELECT * FROM fct_drivers"),
)
def daily_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).read(*daily.DRIVERS)


@query("i_daily_coding_rate", with_ctes(*ctes.ALL_CODING, select="SELECT * FROM fct_coding"))
def daily_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All calls arrive first; the dispositions that their notes name follow up to weeks later."""
    return _daily(spark, sf_dir).read(*daily.CODING)


@query(
    "i2_dates_recoded",
    with_ctes(
        *ctes.ALL_CODED,
        select=f"""
        SELECT DISTINCT called_at_local::DATE AS call_date FROM coded
        WHERE matched_disposed_at_utc::DATE + (matched_call_log_id % 3)::INTEGER > DATE '{_RUNS[-2]}'""",
    ),
)
def dates_recoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call dates that the last day's dispositions code anew, from the two indexes."""
    tables = _daily(spark, sf_dir)
    last = max(tables.first_values("raw", schemas.DISPOSITIONS))
    named = daily.notes_naming(tables, {last})
    return named.select(daily.CALL_DATE).distinct()


_CALLED = (date(1995, 1, 1), date(1996, 12, 31))
_DISPOSED = (date(2024, 1, 10), date(2024, 1, 24))


def _within(column: str, days: tuple[date, date]) -> str:
    return f"{column} BETWEEN DATE '{days[0]}' AND DATE '{days[1]}'"


@query(
    "k1_coding_rate_of_a_period",
    with_ctes(
        *ctes.ALL_CODED,
        select=f"""
        SELECT count(*) FILTER (is_coded) AS coded_calls, count(*) AS total_calls,
               count(*) FILTER (is_coded)::DOUBLE / count(*) AS coding_rate
        FROM coded WHERE {_within("called_at_local::DATE", _CALLED)}""",
    ),
)
def k1_of_a_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.coding_rate_overall(states.period(_daily(spark, sf_dir), daily.CODING, *_CALLED))


@query(
    "k2_paid_post_call_of_a_period",
    with_ctes(
        *ctes.ALL_PAID,
        select=f"""
        SELECT count(*) FILTER (is_paid_post_call) AS paid_calls, count(*) AS assessable_calls,
               count(*) FILTER (is_paid_post_call)::DOUBLE / count(*) AS paid_rate
        FROM fct_paid WHERE is_window_closed AND {_within("disposed_at_utc::DATE", _DISPOSED)}""",
    ),
)
def k2_of_a_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.paid_post_call_of_states(states.period(_daily(spark, sf_dir), daily.PAID, *_DISPOSED))


@query(
    "k3_value_recovered_of_a_period",
    with_ctes(
        *ctes.ALL_VALUE,
        select=f"""
        SELECT market, grouping(market)::INTEGER AS is_total,
               round(sum(amount_local / rate), 4) AS value_recovered_usd
        FROM attribution LEFT JOIN newest USING (currency)
        WHERE is_paid_post_call AND {_within("pay_timestamp_utc::DATE", _DISPOSED)}
        GROUP BY ROLLUP (market)""",
    ),
)
def k3_of_a_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = states.period(_daily(spark, sf_dir), daily.VALUE, *_DISPOSED)
    return models.money(rollups.value_recovered_by_market(value), "value_recovered_usd")


@query(
    "a10_drill_down_of_a_period",
    with_ctes(
        *ctes.ALL_DRIVERS,
        select=f"""
        SELECT level_one, level_two, level_three,
               grouping(level_one, level_two, level_three)::INTEGER AS depth_id,
               count(*) AS call_count
        FROM hierarchy WHERE {_within("disposed_at_utc::DATE", _DISPOSED)}
        GROUP BY ROLLUP (level_one, level_two, level_three)""",
    ),
)
def a10_of_a_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.driver_drill_down(states.period(_daily(spark, sf_dir), daily.DRIVERS, *_DISPOSED))


_SEEN = f"<= DATE '{_RUNS[1]}'"
# Paid post call as the second run published it: of the rows that had arrived, at that run's clock.
_PUBLISHED_SQL = with_ctes(
    fx.DISPOSITIONS_SQL.replace("raw_dispositions AS", "all_dispositions AS"),
    fx.PAYMENTS_SQL.replace("raw_payments AS", "all_payments AS"),
    f"""raw_dispositions AS (SELECT * FROM all_dispositions
        WHERE created_timestamp_utc::DATE + (call_log_id % 3)::INTEGER {_SEEN})""",
    f"""raw_payments AS (SELECT * FROM all_payments
        WHERE pay_timestamp_utc::DATE + (contract_id % 3)::INTEGER {_SEEN})""",
    ctes.STG_DISPOSITIONS,
    ctes.STG_PAYMENTS,
    ctes.ATTRIBUTION.replace(fx.AS_OF_SQL, f"TIMESTAMP '{_RUNS[1]} 00:00:00'"),
    ctes.FCT_PAID,
    select="SELECT *, disposed_at_utc::DATE AS day FROM fct_paid",
)


@query(
    "t3_restated_paid_post_call",
    with_ctes(
        f"old AS ({_PUBLISHED_SQL})",
        *ctes.ALL_PAID,
        "new AS (SELECT *, disposed_at_utc::DATE AS day FROM fct_paid WHERE disposed_at_utc::DATE IN (SELECT day FROM old))",
        select="""
        SELECT day AS published_date,
               count(*) FILTER (o.call_log_id IS NULL) AS added,
               count(*) FILTER (n.call_log_id IS NULL) AS removed,
               count(*) FILTER (o.call_log_id = n.call_log_id) AS changed,
               coalesce(sum(o.is_paid_post_call::BIGINT), 0)::BIGINT AS paid_before,
               coalesce(sum(n.is_paid_post_call::BIGINT), 0)::BIGINT AS paid_after,
               coalesce(sum(o.attributed_payment_count), 0)::BIGINT AS payments_before,
               coalesce(sum(n.attributed_payment_count), 0)::BIGINT AS payments_after
        FROM old o FULL JOIN new n USING (day, call_log_id)
        WHERE (o.call_log_id, o.is_window_closed, o.attributed_payment_count)
          IS DISTINCT FROM (n.call_log_id, n.is_window_closed, n.attributed_payment_count)
        GROUP BY day""",
    ),
)
def restated_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the third run moved on dates that the second had published."""
    kept = restate.changes(_daily(spark, sf_dir), daily.PAID, [len(_RUNS)])
    paid = F.col("row.is_paid_post_call").cast("bigint")
    return restate.moved(kept, paid=paid, payments=F.col("row.attributed_payment_count")).drop(restate.COMMIT)


@query("i6_rerun_paid_post_call", with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid"))
def rerun_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run again, over files that it has seen."""
    tables = _daily(spark, sf_dir)
    base = tables.root.rsplit("/", 1)[0]
    daily.run_daily(
        spark, f"{base}/raw", tables.root, deliveries.midnight(_RUNS[-1]), fx_payload=f"{base}/latest.json"
    )
    return tables.read(*daily.PAID).drop(daily.DISPOSED_DATE)


def _full_build(spark: SparkSession, sf_dir: str) -> Tables:
    """All files in one run."""
    key = ("full", spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        base = shared_folder(spark, "full")
        payload = f"{base}/latest.json"
        write_text(spark, payload, deliveries.payload(_RATES))
        for after, upto in _spans():
            _deliver(spark, sf_dir, f"{base}/raw", after, upto)
        daily.run_daily(
            spark, f"{base}/raw", f"{base}/out", fx.AS_OF, full_refresh=True, fx_payload=payload
        )
        _runs[key] = Tables(spark, f"{base}/out")
    return _runs[key]


@query("r1_full_build_coding_rate", with_ctes(*ctes.ALL_CODING, select="SELECT * FROM fct_coding"))
def full_coding_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_build(spark, sf_dir).read(*daily.CODING)


@query("r1_full_build_paid_post_call", with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid"))
def full_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_build(spark, sf_dir).read(*daily.PAID).drop(daily.DISPOSED_DATE)


@query(
    "r1_full_build_dim_agent",
    with_ctes(
        *ctes.MAPPING, select="SELECT ameyo_user_id, atlas_user_name, team, market FROM stg_mapping"
    ),
)
def full_dim_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_build(spark, sf_dir).read(*daily.DIM_AGENT)


_SERVED = {
    "dim_agent": (ctes.MAPPING, "stg_mapping"),
    "fct_coding_rate": (ctes.ALL_CODING, "fct_coding"),
    "fct_paid_post_call": (ctes.ALL_PAID, "fct_paid"),
    "fct_value_recovered_usd": (ctes.ALL_VALUE, "fct_value"),
    "fct_inbound_call_drivers": (ctes.ALL_DRIVERS, "fct_drivers"),
}


@query(
    "s18_served_rows",
    " UNION ALL ".join(
        f"(WITH {', '.join(c.strip() for c in parts)} SELECT '{name}' AS table_name, count(*) AS n FROM {cte})"
        for name, (parts, cte) in _SERVED.items()
    ),
)
def served_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all five marts under their schema-qualified names."""
    tables = _full_build(spark, sf_dir)
    counted = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        for name, df in daily.serving(tables, f"served_{uuid.uuid4().hex}").items()
    ]
    return reduce(DataFrame.unionAll, counted)


@query("t2_streamed_paid_post_call", with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid"))
def streamed_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).read(*daily.PAID).drop(daily.DISPOSED_DATE)


@query("d4_marts_after_failing_day", with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid"))
def after_failing_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files in one run, then a day with more payments whose checks fail: the marts are those of before."""
    base = shared_folder(spark, "failing")
    payload = f"{base}/latest.json"
    write_text(spark, payload, deliveries.payload(_RATES))
    for after, upto in _spans():
        _deliver(spark, sf_dir, f"{base}/raw", after, upto)
    run = {"raw_dir": f"{base}/raw", "out_dir": f"{base}/out", "as_of": fx.AS_OF, "fx_payload": payload}
    daily.run_daily(spark, **run)
    more = fx.payments(spark, sf_dir).withColumn("amount", F.col("amount") + 1000)
    deliveries.write_csv(more, f"{base}/raw", date(2024, 2, 1), schemas.PAYMENTS)
    try:
        daily.run_daily(spark, **run, providers=["none of these"])
        raise RuntimeError("a day with payments of unknown providers was published")
    except QualityError:
        return Tables(spark, f"{base}/out").read(*daily.PAID).drop(daily.DISPOSED_DATE)


_STORE = "spark.sql.streaming.stateStore.providerClass"
_FAR = 10**18


def _owner_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the streamed owners: rows arrive up to two days after the event, in three deliveries
    whose last also holds a row of a far time, with which all windows close."""
    key = ("owners", spark.sparkContext.applicationId, sf_dir)
    if key in _changes:
        return _changes[key]
    base = shared_folder(spark, "owners")
    rows = owners.arrivals(models.dispositions(spark, sf_dir), models.payments(spark, sf_dir))
    delay = F.pmod(F.xxhash64("us", "call_log_id", "contract_id"), F.lit(2 * 86_400_000_000))
    arrives = F.to_date(F.timestamp_micros(F.col("us") + delay))
    end = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("contract_id"),
        F.lit(_FAR // 1000 * 2).cast("bigint").alias("us"),
        F.lit(-1).cast("bigint").alias("call_log_id"),
        F.lit("").alias("market"),
        F.lit("~").alias("currency"),
        F.lit(1.0).alias("amount_local"),
    )
    buckets = owners.buckets_for(rows.agg(F.approx_count_distinct("contract_id")).first()[0])
    old = spark.conf.get(_STORE)
    spark.conf.set(_STORE, owners.PROVIDER)
    try:
        for (after, upto), last in zip(_spans(), (False, False, True), strict=True):
            part = rows.filter((arrives > F.lit(after)) & (arrives <= F.lit(upto)))
            part.write.parquet(f"{base}/in/{upto}")
            if last:
                end.write.mode("append").parquet(f"{base}/in/{upto}")
            source = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
            owners.owner_changes(source, "2 days 1 second", buckets).writeStream.option(
                "checkpointLocation", f"{base}/checkpoint"
            ).trigger(availableNow=True).format("parquet").start(f"{base}/out").awaitTermination()
    finally:
        spark.conf.set(_STORE, old)
    _changes[key] = spark.read.parquet(f"{base}/out")
    return _changes[key]


@query("t2_streamed_owners", with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid"))
def streamed_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid post call from the changes of the stateful stream: opened, paid, retracted."""
    return owners.paid_post_call_of(_owner_changes(spark, sf_dir), fx.AS_OF)


@query(
    "t2_closed_windows",
    with_ctes(*ctes.ALL_PAID, select="SELECT call_log_id, attributed_payment_count AS payments FROM fct_paid"),
)
def closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream says of each disposition when its window closes."""
    changes = _owner_changes(spark, sf_dir)
    return changes.filter("change = 'closed'").select("call_log_id", "payments")
