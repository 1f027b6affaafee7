"""The daily job: land files and rates, rebuild the marts' dates that can have changed, check."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope import schemas
from callscope.functions import ntz
from callscope.functions.times import ATTRIBUTION_DAYS
from callscope.operators import quality
from callscope.operators.coding import with_candidate_id
from callscope.operators.skew import SPLIT_ROWS
from callscope.plans import incremental, intermediate, marts, restate, sketches, staging, states
from callscope.plans.incremental import Scope
from callscope.plans.marts import FxRule
from callscope.sources import fx, key_index, landing, manifest
from callscope.sources.key_index import BUCKET
from callscope.sources.landing import EVENT_DATE, Landed, read_raw
from callscope.sources.tables import Tables

ATTRIBUTION = ("intermediate", "int_calls_payment_attribution")
DIM_AGENT = ("marts", "dim_agent")
CODING = ("marts", "fct_coding_rate")
PAID = ("marts", "fct_paid_post_call")
VALUE = ("marts", "fct_value_recovered_usd")
DRIVERS = ("marts", "fct_inbound_call_drivers")
# Ids named in notes, by call date and bucket; and ids of dispositions whose extracts are landed again.
NOTED = ("intermediate", "int_note_index")
RELANDED = ("intermediate", "relanded_ids")
MARTS = (CODING, PAID, VALUE, DRIVERS, DIM_AGENT)
RUN_STATE = ("intermediate", "run_state")
# Date column and key of the marts whose changes can be kept.
CHANGE_KEYS = {
    CODING: ("call_date", "coding_rate_id"),
    PAID: ("disposed_date", "call_log_id"),
    VALUE: ("call_date", "value_recovered_id"),
    DRIVERS: ("call_date", "driver_id"),
}

DISPOSED_DATE = "disposed_date"
CALL_DATE = "call_date"


@dataclass
class DailyReport:
    landed: list[Landed] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)


def raw_of(tables: Tables, table: str, scope: Scope) -> DataFrame:
    """Raw rows of the dates in scope; other event-date partitions are not read."""
    return read_raw(tables, table).filter(scope.holds(F.col(EVENT_DATE)))


def _last_as_of(tables: Tables) -> datetime | None:
    if not tables.exists(*RUN_STATE):
        return None
    return tables.read(*RUN_STATE).select("as_of").head()[0]


def land(
    spark: SparkSession, tables: Tables, raw_dir: str, full_refresh: bool = False, verify: bool = False
) -> list[Landed]:
    """All files on a full refresh or a first run, else the extracts with new, changed or removed files.

    The hashes are taken first and count as known only after the whole run: a run that breaks off
    lands the same files again and still knows which dates they touch.
    """
    known = None if full_refresh else manifest.known_files(tables)
    tables.overwrite(manifest.file_hashes(spark, raw_dir, known, verify), *manifest.SEEN)
    if known is None:
        return landing.land_all(spark, tables, raw_dir)
    seen = tables.read(*manifest.SEEN)
    other = manifest.changed_files(seen, known).select("path").union(
        manifest.removed_files(seen, known).select("path")
    )
    # Paths of one run's changes.
    paths = [r["path"] for r in other.collect()]
    keep_ids(tables, paths)
    return landing.land_files(spark, tables, raw_dir, paths)


def keep_ids(tables: Tables, paths: list[str]) -> None:
    """Note the dispositions of extracts about to be replaced: calls may lose what they named.

    What a run that broke off has noted stays until a run ends.
    """
    days = landing.days_of(paths, schemas.ENTITIES[schemas.DISPOSITIONS])
    days -= {p[landing.EXTRACT_DATE] for p in tables.partitions(*RELANDED)}
    if days and tables.exists("raw", schemas.DISPOSITIONS):
        ids = _ids_of_extracts(tables, days)
        tables.replace_partitions(ids, *RELANDED, [landing.EXTRACT_DATE], in_scope=lambda _: False)


def _ids_of_extracts(tables: Tables, days: Iterable[str]) -> DataFrame:
    raw = read_raw(tables, schemas.DISPOSITIONS).filter(F.col(landing.EXTRACT_DATE).isin(sorted(days)))
    ids = raw.select(F.col("call_log_id").try_cast("bigint").alias("call_log_id"), landing.EXTRACT_DATE)
    return ids.filter(F.col("call_log_id").isNotNull()).distinct()


def build_attribution(
    tables: Tables, scope: Scope, as_of: datetime, split_rows: int = SPLIT_ROWS
) -> dict[str, int]:
    """Attribution and paid post call of the disposition dates in scope.

    Who owns a payment is decided by the dispositions of the three days before it, so a date needs
    the rows of the three days after it and none of earlier ones.
    """
    reads = scope.and_days_after(ATTRIBUTION_DAYS)
    disposed_date = F.to_date("disposed_at_utc")
    attribution = intermediate.int_calls_payment_attribution(
        staging.stg_dispositions(raw_of(tables, schemas.DISPOSITIONS, reads)),
        staging.stg_payments(raw_of(tables, schemas.PAYMENTS, reads)),
        as_of,
        split_rows,
    ).filter(scope.holds(disposed_date))
    attribution = attribution.withColumn(DISPOSED_DATE, disposed_date)
    attributed = incremental.rebuild(tables, attribution, *ATTRIBUTION, DISPOSED_DATE, scope)
    paid = marts.fct_paid_post_call(
        tables.read(*ATTRIBUTION).filter(scope.holds(F.col(DISPOSED_DATE)))
    )
    paid = paid.withColumn(DISPOSED_DATE, disposed_date)
    calls = incremental.rebuild(tables, paid, *PAID, DISPOSED_DATE, scope)
    return {ATTRIBUTION[1]: attributed, PAID[1]: calls}


def build_value(
    tables: Tables, scope: Scope, fx_rule: FxRule = "latest", known_at: datetime | None = None
) -> dict[str, int]:
    """Value recovered, by payment date, after the disposition dates in scope were rebuilt.

    These can own payments of the three days after them. Those payment dates are summed again from
    all dispositions that can own their payments. A payment without a rate fails the run. With
    ``known_at`` only rates fetched by then are used.
    """
    rates = fx.read_rates(tables, known_at)
    attribution = tables.read(*ATTRIBUTION)
    disposed = F.col(DISPOSED_DATE)
    rebuilt = attribution.filter(scope.holds(disposed))
    quality.require_rates(marts.priced_payments(rebuilt, rates, fx_rule))
    pay_dates = scope.and_days_after(ATTRIBUTION_DAYS)
    owners = pay_dates.and_days_before(ATTRIBUTION_DAYS)
    payments = attribution.filter(
        owners.holds(disposed) & pay_dates.holds(F.to_date("pay_timestamp_utc"))
    )
    value = marts.fct_value_recovered_usd(payments, rates, fx_rule)
    return {VALUE[1]: incremental.rebuild(tables, value, *VALUE, CALL_DATE, pay_dates)}


def coding_dates(tables: Tables, landed: list[Landed]) -> set[date]:
    """Call dates whose coding can have changed without a call arriving.

    Those of calls that name a disposition of an extract that landed, before or after, and of calls
    by an agent whose mapping differs from the one in use. As many as the calendar has.
    """
    found: set[date] = set()
    days = {d for load in landed if load.table == schemas.DISPOSITIONS for d in load.days}
    if days and tables.exists(*NOTED):
        named = notes_naming(tables, days)
        found |= {r[CALL_DATE] for r in named.select(CALL_DATE).distinct().collect()}
    if tables.exists(*CODING) and any(load.table == schemas.AGENT_MAPPING for load in landed):
        old, new = tables.read(*DIM_AGENT), _agents(tables).select(tables.read(*DIM_AGENT).columns)
        other = old.exceptAll(new).union(new.exceptAll(old)).select("ameyo_user_id").distinct()
        if not other.isEmpty():
            touched = tables.read(*CODING).join(other, "ameyo_user_id", "left_semi")
            found |= {r[CALL_DATE] for r in touched.select(CALL_DATE).distinct().collect()}
    return found - {None}


def notes_naming(tables: Tables, days: Iterable[str]) -> DataFrame:
    """Note ids, with their call date, that name a disposition which these extracts have or had.

    Only the buckets of these dispositions are opened, of the index of notes too.
    """
    key_index.ensure(tables, schemas.DISPOSITIONS)
    buckets = key_index.buckets_of_extracts(tables, schemas.DISPOSITIONS, days)
    landed = key_index.of_extracts(tables, schemas.DISPOSITIONS, days)
    ids = landed.select(F.col(key_index.KEY).try_cast("bigint").alias("call_log_id"))
    if tables.exists(*RELANDED):
        before = tables.read(*RELANDED).select("call_log_id")
        of_key = key_index.bucket_of(F.col("call_log_id")).alias(BUCKET)
        # As many as there are buckets.
        buckets |= {r[BUCKET] for r in before.select(of_key).distinct().collect()}
        ids = ids.unionByName(before)
    noted = key_index.in_buckets(tables.read(*NOTED), buckets)
    return noted.join(ids.distinct(), F.col("candidate_call_log_id") == F.col("call_log_id"), "left_semi")


def dispositions_named(tables: Tables, scope: Scope) -> DataFrame:
    """Id, contract and time of the dispositions named in notes of the call dates in scope.

    They come from the index, from the buckets that these notes have.
    """
    in_scope = scope.has_partition(CALL_DATE)
    days = {d for d in tables.first_values(*NOTED) if in_scope({CALL_DATE: d})}
    buckets = key_index.buckets_of(tables.partitions(*NOTED, days))
    noted = tables.read(*NOTED).filter(scope.holds(F.col(CALL_DATE)))
    named = noted.select("candidate_call_log_id").distinct()
    key_index.ensure(tables, schemas.DISPOSITIONS)
    known = key_index.in_buckets(tables.read("index", schemas.DISPOSITIONS), buckets)
    return staging.stg_disposition_keys(known).join(
        named, F.col("call_log_id") == F.col("candidate_call_log_id"), "left_semi"
    )


def _agents(tables: Tables) -> DataFrame:
    return marts.dim_agent(staging.stg_agent_mapping(read_raw(tables, schemas.AGENT_MAPPING)))


def build_coding(tables: Tables, scope: Scope, split_rows: int = SPLIT_ROWS) -> dict[str, int]:
    """Agents, few and rebuilt whole, and the coding rate of the call dates in scope.

    Only the dispositions that a note in scope names take part in the join, without reading others.
    """
    agents = tables.overwrite(_agents(tables), *DIM_AGENT)
    calls = staging.stg_calls(raw_of(tables, schemas.CALLS, scope))
    noted = with_candidate_id(calls).select(
        "candidate_call_log_id", F.to_date("called_at_local").alias(CALL_DATE)
    )
    noted = noted.filter(F.col("candidate_call_log_id").isNotNull()).distinct()
    noted = noted.withColumn(BUCKET, key_index.bucket_of(F.col("candidate_call_log_id")))
    incremental.rebuild(tables, noted, *NOTED, CALL_DATE, scope, [BUCKET])
    coded = intermediate.int_calls_coded(calls, dispositions_named(tables, scope), split_rows)
    coding = marts.fct_coding_rate(coded, tables.read(*DIM_AGENT))
    rows = incremental.rebuild(tables, coding, *CODING, CALL_DATE, scope)
    return {DIM_AGENT[1]: agents, CODING[1]: rows}


def build_drivers(tables: Tables, scope: Scope) -> dict[str, int]:
    """Inbound drivers of the disposition dates in scope."""
    hierarchy = intermediate.int_dispositions_hierarchy(
        staging.stg_dispositions(raw_of(tables, schemas.DISPOSITIONS, scope))
    )
    drivers = marts.fct_inbound_call_drivers(hierarchy)
    return {DRIVERS[1]: incremental.rebuild(tables, drivers, *DRIVERS, CALL_DATE, scope)}


def build(
    spark: SparkSession,
    tables: Tables,
    landed: list[Landed],
    as_of: datetime,
    full_refresh: bool = False,
    fx_rule: FxRule = "latest",
    split_rows: int = SPLIT_ROWS,
    written: dict[str, Scope] | None = None,
    rates_as_known: bool = False,
) -> dict[str, int]:
    """Bring intermediate and mart tables up to date with raw. Returns rows written per table.

    ``written`` gets the dates rebuilt of each mart.
    """
    touched: dict[str, set[date]] = {name: set() for name in schemas.ENTITIES}
    for load in landed:
        touched[load.table] |= load.event_dates

    def lookback(table: tuple[str, str], dates: set[date]) -> Scope:
        if full_refresh or (table == CODING and not tables.exists(*NOTED)):
            return Scope.everything()
        existing = tables.dates(*table, CALL_DATE)
        return incremental.lookback(existing, incremental.LOOKBACK_DAYS, dates)

    recoded = touched[schemas.CALLS] | (set() if full_refresh else coding_dates(tables, landed))

    attribution_scope = (
        Scope.everything()
        if full_refresh
        else incremental.attribution_scope(
            tables.dates(*ATTRIBUTION, DISPOSED_DATE),
            touched[schemas.DISPOSITIONS] | touched[schemas.PAYMENTS],
            as_of,
            _last_as_of(tables),
        )
    )
    coding_scope = lookback(CODING, recoded)
    rows = build_attribution(tables, attribution_scope, as_of, split_rows)
    rows |= build_value(tables, attribution_scope, fx_rule, as_of if rates_as_known else None)
    rows |= build_coding(tables, coding_scope, split_rows)
    drivers_scope = lookback(DRIVERS, touched[schemas.DISPOSITIONS])
    rows |= build_drivers(tables, drivers_scope)
    value_scope = attribution_scope.and_days_after(ATTRIBUTION_DAYS)
    rebuilt = {PAID: attribution_scope, VALUE: value_scope, CODING: coding_scope, DRIVERS: drivers_scope}
    for mart, scope in rebuilt.items():
        states.rebuild(tables, mart, scope)
    if written is not None:
        written |= {mart[1]: scope for mart, scope in rebuilt.items()}
    return rows


def finish(tables: Tables, as_of: datetime) -> None:
    """After the marts were published: a run that breaks off before this is repeated with the same scope."""
    if tables.exists(*RELANDED):
        tables.overwrite(tables.read(*RELANDED).limit(0), *RELANDED, [landing.EXTRACT_DATE])
    tables.overwrite(tables.spark.range(1).select(ntz(as_of).alias("as_of")), *RUN_STATE)


def source_checks(tables: Tables, landed: list[Landed] | None = None) -> list[quality.Check]:
    """Keys of calls and dispositions; with ``landed`` only of the extracts that landed.

    Whether a landed key is unique is asked of the key index, in the buckets of the landed keys.
    """
    checks = []
    for table, key in ((schemas.CALLS, "ch_call_id"), (schemas.DISPOSITIONS, "call_log_id")):
        rows = fresh = read_raw(tables, table)
        if landed is not None:
            key_index.ensure(tables, table)
            days = {d for load in landed if load.table == table for d in load.days}
            fresh = rows.filter(F.col(landing.EXTRACT_DATE).isin(sorted(days)))
            rows = key_index.sharing_keys(tables, table, days).withColumnRenamed(key_index.KEY, key)
        checks += [quality.unique(table, rows, key), quality.not_null(table, fresh, key)]
    return checks


def mart_checks(tables: Tables, written: dict[str, Scope] | None = None) -> list[quality.Check]:
    """Keys and ranges of the marts; with ``written`` only of the dates in scope.

    A disposition has one date, so its row is unique if it is so within the date.
    """

    def rows(table: tuple[str, str], column: str) -> DataFrame:
        scope = (written or {}).get(table[1], Scope.everything())
        return tables.read(*table).filter(scope.holds(F.col(column)))

    agents, coding = tables.read(*DIM_AGENT), rows(CODING, CALL_DATE)
    paid, value = rows(PAID, DISPOSED_DATE), rows(VALUE, CALL_DATE)
    return [
        quality.unique(DIM_AGENT[1], agents, "ameyo_user_id"),
        quality.not_null(DIM_AGENT[1], agents, "ameyo_user_id"),
        quality.accepted_range(CODING[1], coding, "coding_rate", 0, 1),
        quality.unique(PAID[1], paid, "call_log_id"),
        quality.not_null(PAID[1], paid, "call_log_id"),
        quality.not_null(VALUE[1], value, "value_recovered_usd"),
    ]


def drift_checks(
    tables: Tables, max_blank_notes: float | None = None, providers: list[str] | None = None
) -> list[quality.Check]:
    """Checks that notice a change in the deliveries, for the limits given: blank notes, providers."""
    checks = []
    if max_blank_notes is not None:
        calls = staging.stg_calls(read_raw(tables, schemas.CALLS))
        checks.append(quality.blank_share_at_most("stg_calls", calls, "call_notes_raw", max_blank_notes))
    if providers is not None:
        payments = staging.stg_payments(read_raw(tables, schemas.PAYMENTS))
        checks.append(quality.accepted_values("stg_payments", payments, "payment_request_provider", providers))
    return checks


def run_daily(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    as_of: datetime,
    full_refresh: bool = False,
    fx_payload: str | None = None,
    fx_rule: FxRule = "latest",
    split_rows: int = SPLIT_ROWS,
    max_blank_notes: float | None = None,
    providers: list[str] | None = None,
    verify: bool = False,
    keep_changes: Iterable[tuple[str, str]] = (),
    rates_as_known: bool = False,
    keep_sketches: bool = False,
) -> DailyReport:
    """Land what is new, load the day's rates, rebuild and check. ``as_of`` is naive UTC.

    Steps follow each other. The marts are written, checked and then published in one commit; a
    failing check raises and leaves all marts as they were. The drift checks run if their limits are
    given. With ``verify`` every delivered file is read to see whether it changed. Of the marts in
    ``keep_changes`` the differences from what was published before are kept (``plans.restate``).
    With ``rates_as_known`` payments are priced with the rates fetched by ``as_of``, so that a rerun
    for an old day prices them as then. With ``keep_sketches`` extracts are sketched as they
    land, in this and all later runs (``plans.sketches``).
    """
    tables = Tables(spark, out_dir)
    first = full_refresh or manifest.known_files(tables) is None
    report = DailyReport(land(spark, tables, raw_dir, full_refresh, verify))
    for landed in report.landed:
        if keep_sketches or tables.exists(sketches.SCHEMA, landed.table):
            sketches.update(tables, landed.table, None if first else landed.days)
    if fx_payload:
        report.rows[schemas.FX_RATES] = fx.load_payload(tables, fx_payload, as_of)
    quality.run_checks(source_checks(tables, None if first else report.landed))
    written: dict[str, Scope] = {}
    with tables.publishing():
        report.rows |= build(
            spark, tables, report.landed, as_of, full_refresh, fx_rule, split_rows, written, rates_as_known
        )
        drift = drift_checks(tables, max_blank_notes, providers)
        quality.run_checks(mart_checks(tables, written) + drift)
        for mart in keep_changes:
            restate.keep(tables, mart, *CHANGE_KEYS[mart])
    finish(tables, as_of)
    manifest.remember(tables, tables.read(*manifest.SEEN))
    return report


def serving(tables: Tables, database: str | None = None) -> dict[str, DataFrame]:
    """The marts as ``marts.<name>``, or in another database, for ``SELECT *``."""
    return {name: tables.register(schema, name, database) for schema, name in MARTS}
