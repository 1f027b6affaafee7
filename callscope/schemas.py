"""Raw tables: column names, the file each is delivered in and its event-time column.

Every raw column lands as a string; staging casts it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Entity names, file names and column names of the delivered extracts.
CALLS = "ameyo_outbound_calls"
DISPOSITIONS = "atlas_calls_dispositions"
PAYMENTS = "atlas_payments"
AGENT_MAPPING = "atlas_ameyo_mapping"
FX_RATES = "fx_rates"
# Every fetch of every rate; ``FX_RATES`` holds the last one of each date.
FX_VERSIONS = "fx_rate_versions"


@dataclass(frozen=True)
class Entity:
    """One delivered extract: ``{raw_dir}/{YYYY-MM-DD}/{name}.csv``."""

    name: str
    columns: tuple[str, ...]
    event_time: str | None = None
    #: Values may hold line ends. Such a file is read by one task; parts of an extract are parallel.
    multi_line: bool = False
    #: Unique column, and the columns kept with it in the key index.
    key: str | None = None
    indexed: tuple[str, ...] = ()

    @property
    def file_name(self) -> str:
        return f"{self.name}.csv"


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            CALLS,
            (
                "ch_call_id",
                "ch_date_added",
                "ch_contact_center_id",
                "ch_system_disposition",
                "ch_call_type",
                "total_talk_time",
                "udh_user_id",
                "campaign_name",
                "udh_notes",
            ),
            "ch_date_added",
            multi_line=True,
            key="ch_call_id",
        ),
        Entity(
            DISPOSITIONS,
            (
                "call_log_id",
                "tenant_id",
                "customer_id",
                "contract_id",
                "created_timestamp_utc",
                "createdby",
                "call_type",
                "level_one",
                "level_two",
                "level_three",
            ),
            "created_timestamp_utc",
            key="call_log_id",
            indexed=("contract_id", "created_timestamp_utc"),
        ),
        Entity(
            PAYMENTS,
            (
                "pay_timestamp_utc",
                "tenant_id",
                "contract_id",
                "payment_request_provider",
                "create_program",
                "amount",
            ),
            "pay_timestamp_utc",
        ),
        Entity(
            AGENT_MAPPING,
            ("contact_centre", "ameyo_user_id", "team", "atlas_user_name"),
        ),
    )
}

LINEAGE = ("_source_file", "_loaded_at")

FX_SCHEMA = T.StructType(
    [
        T.StructField("rate_date", T.DateType()),
        T.StructField("currency", T.StringType()),
        T.StructField("local_units_per_usd", T.DoubleType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
        T.StructField("source", T.StringType()),
    ]
)
