"""Exchange-rate payloads -> ``raw.fx_rates``.

A payload is one API answer, JSON text: ``{"result": ..., "conversion_rates": {currency: units}}``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.functions import CURRENCIES, ntz
from callscope.operators.rates import known_rates
from callscope.schemas import FX_RATES, FX_SCHEMA, FX_VERSIONS
from callscope.sources.tables import Tables

# Fixed value: name of the rate provider.
SOURCE = "exchangerate-api.com"
_VERSION = ["rate_date", "fetch"]
_PAYLOAD = "result string, conversion_rates map<string,double>"


class FxPayloadError(ValueError):
    """A payload that cannot be used."""


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Add the parsed ``rates`` map of the needed currencies and ``problem``, null if usable."""
    parsed = payloads.withColumn("p", F.from_json("payload", _PAYLOAD))
    rates = F.map_filter("p.conversion_rates", lambda c, _: c.isin(*CURRENCIES))
    missing = F.filter(
        F.array(*map(F.lit, CURRENCIES)),
        lambda c: F.try_element_at(F.col("p.conversion_rates"), c).isNull(),
    )
    not_positive = F.exists(F.map_values(rates), lambda r: r <= 0)
    problem = (
        F.when(
            F.col("p.result").isNull() | (F.col("p.result") != "success"),
            F.lit("the provider did not answer with success"),
        )
        .when(F.col("p.conversion_rates").isNull(), F.lit("the answer holds no rates"))
        .when(
            F.size(missing) > 0,
            F.concat(F.lit("no rate for "), F.array_join(missing, ", ")),
        )
        .when(not_positive, F.lit("rate not above zero"))
    )
    return parsed.select(*payloads.columns, rates.alias("rates"), problem.alias("problem"))


def rate_rows(payloads: DataFrame, rate_date: Column, fetched_at: Column) -> DataFrame:
    """One row per payload and currency. A payload that cannot be used fails the query."""
    parsed = parse_payloads(payloads)
    checked = F.when(
        F.col("problem").isNotNull(),
        F.raise_error(F.concat(F.lit("fx payload: "), F.col("problem"))).cast(
            "map<string,double>"
        ),
    ).otherwise(F.col("rates"))
    return parsed.select(
        rate_date.alias("rate_date"),
        F.explode(checked).alias("currency", "local_units_per_usd"),
        fetched_at.alias("fetched_at"),
        F.lit(SOURCE).alias("source"),
    )


def stamp(payloads: DataFrame, fetched_at: datetime) -> DataFrame:
    """Rows of payloads fetched at one moment, naive UTC, dated that day."""
    return rate_rows(
        payloads, F.lit(fetched_at.date().isoformat()).cast("date"), ntz(fetched_at)
    )


def upsert_rates(tables: Tables, rows: DataFrame) -> int:
    """Replace the rates of the dates in ``rows``; other dates stay.

    Partitions of dates without rows are untouched, so no date is in scope for removal. What was
    fetched before stays in the versions.
    """
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in FX_SCHEMA])
    _keep_versions(tables, rows)
    return tables.replace_partitions(rows, "raw", FX_RATES, ["rate_date"], lambda p: False)


def _keep_versions(tables: Tables, rows: DataFrame) -> None:
    """Add a fetch of the dates in ``rows``; the same fetch again replaces itself."""
    if not tables.exists("raw", FX_VERSIONS) and tables.exists("raw", FX_RATES):
        # rates loaded before versions were kept
        tables.overwrite(_by_fetch(read_rates(tables)), "raw", FX_VERSIONS, _VERSION)
    tables.replace_partitions(_by_fetch(rows), "raw", FX_VERSIONS, _VERSION, lambda p: False, first=())


def _by_fetch(rows: DataFrame) -> DataFrame:
    return rows.withColumn("fetch", F.date_format("fetched_at", "yyyyMMdd'T'HHmmssSSSSSS"))


def load_payload(tables: Tables, path: str, fetched_at: datetime) -> int:
    """Upsert the rates of one landed payload file."""
    payloads = tables.spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")
    problems = parse_payloads(payloads).filter("problem is not null").select("problem").take(1)
    if problems:
        raise FxPayloadError(problems[0]["problem"])
    return upsert_rates(tables, stamp(payloads, fetched_at))


def read_rates(tables: Tables, known_at: datetime | None = None) -> DataFrame:
    """The rate history; with ``known_at`` as it was then, before later fetches of the same dates."""
    if known_at is None or not tables.exists("raw", FX_VERSIONS):
        rates = tables.read("raw", FX_RATES)
        return rates if known_at is None else known_rates(rates, known_at)
    return known_rates(tables.read("raw", FX_VERSIONS).drop("fetch"), known_at)
