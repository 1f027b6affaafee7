"""Payment attribution: as-of match of each payment to the nearest preceding disposition.

A payment belongs to the latest disposition of its contract that is at most three days older, both
ends included; of dispositions at the same instant the one with the largest id. Payments equal in
contract, instant and amount count once.

Both inputs become one timeline per contract, sorted once. Following it, a payment belongs to the
last disposition passed, and a disposition is paid exactly if the next entry is a payment inside its
window. So one shuffle on the contract gives the attributed payments and the unpaid dispositions,
without candidate pairs and without joining back. If the nearest preceding disposition is more than
three days old, so are all others, hence checking the nearest alone is enough.

Where a contract has too many rows for one task, the whole timeline is scanned in segments instead: it
is range-partitioned on its full order, so that the rows of one contract, of one second and even
equal rows lie in as many segments as they fill. Each segment is walked alone; what one must know of
the others, the last disposition before it and the entries next to it, is a prefix over one row per
segment, and one pass over the walked rows puts it in.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscope.functions import ntz, plain_number, surrogate_key, window_close
from callscope.operators.skew import SPLIT_ROWS, Load, load_of_keys
from callscope.session import shared_folder


def assessable_dispositions(dispositions: DataFrame) -> DataFrame:
    """Without a contract a disposition cannot be assessed; that is not the same as unpaid."""
    return dispositions.filter(F.col("contract_id").isNotNull()).select(
        "call_log_id", "market", "contract_id", "disposed_at_utc"
    )


def recoverable_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(
        F.col("contract_id").isNotNull()
        & F.col("pay_timestamp_utc").isNotNull()
        & (F.col("amount_local") > 0)
    ).select("contract_id", "pay_timestamp_utc", "currency", "amount_local")


def _timeline(dispositions: DataFrame, payments: DataFrame) -> DataFrame:
    """Both inputs as one kind of row; only payments have an amount.

    All window functions below read plain columns of it, so the shuffle carries nothing else. An
    unknown market is an empty string here, as nulls mark the rows that are payments.
    """
    return dispositions.select(
        "contract_id",
        F.col("disposed_at_utc").alias("at"),
        "disposed_at_utc",
        "call_log_id",
        F.coalesce("market", F.lit("")).alias("market"),
    ).unionByName(
        payments.select(
            "contract_id", F.col("pay_timestamp_utc").alias("at"), "currency", "amount_local"
        ),
        allowMissingColumns=True,
    )


_IS_PAYMENT = "amount_local is not null"
_OWNER = ("call_log_id", "market", "disposed_at_utc")
_NEIGHBOUR = ("contract_id", "at", "amount_local")


def _walked(timeline: DataFrame, *group: str) -> DataFrame:
    """Each row of a group with the last disposition up to it and its neighbours, in one sort.

    Dispositions have no amount and so come before the payments of their instant, and equal
    payments are neighbours.
    """
    order = Window.partitionBy(*group).orderBy(
        "at", F.asc_nulls_first("amount_local"), "call_log_id", F.asc_nulls_last("currency")
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return timeline.select(
        "*",
        # The last disposition up to the row; of a disposition, itself.
        *[F.last(c, ignorenulls=True).over(so_far).alias(f"owner_{c}") for c in _OWNER],
        *[F.lag(c).over(order).alias(f"{c}_before") for c in _NEIGHBOUR],
        *[F.lead(c).over(order).alias(f"{c}_after") for c in _NEIGHBOUR],
    )


def _decided(walked: DataFrame) -> DataFrame:
    """The attributed payments and unpaid dispositions."""
    is_payment = F.expr(_IS_PAYMENT)
    copy = (F.col("at_before") == F.col("at")) & (F.col("amount_local_before") == F.col("amount_local"))
    in_window = F.col("at") <= window_close(F.col("owner_disposed_at_utc"))
    paid = F.col("amount_local_after").isNotNull() & (F.col("at_after") <= window_close(F.col("at")))
    attributed = is_payment & in_window & ~F.coalesce(copy, F.lit(False))
    unpaid = ~is_payment & ~F.coalesce(paid, F.lit(False))
    return walked.filter(attributed | unpaid)


def _result(walked: DataFrame) -> DataFrame:
    return walked.select(
        F.col("owner_call_log_id").alias("call_log_id"),
        F.nullif(F.col("owner_market"), F.lit("")).alias("market"),
        "contract_id",
        F.col("owner_disposed_at_utc").alias("disposed_at_utc"),
        F.when(F.expr(_IS_PAYMENT), F.col("at")).alias("pay_timestamp_utc"),
        "currency",
        "amount_local",
    )


def in_segments(timeline: DataFrame, segments: int) -> DataFrame:
    """The timeline dealt by its whole order, with the number of the ``segment`` a row is in.

    The last key is random: equal rows too go to as many segments as they fill.
    """
    order = ("contract_id", "at", F.asc_nulls_first("amount_local"), "call_log_id", F.asc_nulls_last("currency"))
    salted = timeline.withColumn("salt", F.rand(7))
    return salted.repartitionByRange(segments, *order, "salt").drop("salt").withColumn("segment", F.spark_partition_id())


def _carries(walked: DataFrame) -> DataFrame:
    """What each segment must know of the others, one row each.

    Structs compare by contract first, so the greatest disposition of all segments before is the
    last one passed, whichever contract it is of.
    """
    owner = F.struct("contract_id", "disposed_at_utc", "call_log_id", "market")
    row = F.struct(*_NEIGHBOUR)
    ends = walked.groupBy("segment").agg(
        F.max(F.when(~F.expr(_IS_PAYMENT), owner)).alias("owner"), F.min(row).alias("first"), F.max(row).alias("last")
    )
    # Not split: there is one row per segment.
    order = Window.orderBy("segment")
    return ends.select(
        "segment",
        F.max("owner").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("owner_before"),
        F.lag("last").over(order).alias("before"),
        F.lead("first").over(order).alias("after"),
    )


def _corrected(walked: DataFrame, carries: DataFrame) -> DataFrame:
    """The walked rows with what lies outside their segment put in where the contract is the same."""

    def of_same(carry: str, unknown: Column, column: str, name: str) -> Column:
        same = unknown & (F.col(f"{carry}.contract_id") == F.col("contract_id"))
        return F.when(same, F.col(f"{carry}.{column}")).otherwise(F.col(name)).alias(name)

    no_owner = F.col("owner_call_log_id").isNull()
    first, last = F.col("contract_id_before").isNull(), F.col("contract_id_after").isNull()
    return walked.join(F.broadcast(carries), "segment").select(
        "contract_id",
        "at",
        "currency",
        "amount_local",
        *[of_same("owner_before", no_owner, c, f"owner_{c}") for c in _OWNER],
        *[of_same("before", first, c, f"{c}_before") for c in _NEIGHBOUR],
        *[of_same("after", last, c, f"{c}_after") for c in _NEIGHBOUR],
    )


def _scanned_in_segments(timeline: DataFrame, segments: int) -> DataFrame:
    """Attributed payments and unpaid dispositions by a segmented scan.

    The walked segments are a table: carries and rows must come from one dealing, also if an
    executor is lost.
    """
    spark = timeline.sparkSession
    walked = _walked(in_segments(timeline, segments), "segment", "contract_id")
    path = shared_folder(spark, "attribution")
    walked.write.parquet(path)
    walked = spark.read.schema(walked.schema).parquet(path)
    return _decided(_corrected(walked, _carries(walked)))


def segments_for(timeline: DataFrame, load: Load) -> int:
    """As many segments as shuffle partitions, and so many that none has more than ``SPLIT_ROWS`` rows."""
    partitions = int(timeline.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-load.rows // SPLIT_ROWS))


def attribute_payments(
    dispositions: DataFrame, payments: DataFrame, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Rows (disposition x attributed payment), and one row with null payment per unpaid one.

    Takes staging frames. The rows of each contract are counted first, map-side; the largest count
    says whether contracts fit in tasks (one shuffle on the contract) or the timeline is scanned in
    segments. Both give the same rows.
    """
    timeline = _timeline(assessable_dispositions(dispositions), recoverable_payments(payments))
    load = load_of_keys(timeline, F.col("contract_id"))
    if load.most <= split_rows:
        return _result(_decided(_walked(timeline, "contract_id")))
    return _result(_scanned_in_segments(timeline, segments_for(timeline, load)))


def with_window_state(attributed: DataFrame, as_of: datetime) -> DataFrame:
    """Key, window close time, settled flag as of a given time, and paid flag."""
    closes = window_close(F.col("disposed_at_utc"))
    return attributed.select(
        surrogate_key(
            F.col("call_log_id"), F.col("pay_timestamp_utc"), plain_number(F.col("amount_local"))
        ).alias("attribution_id"),
        "call_log_id",
        "market",
        "contract_id",
        "disposed_at_utc",
        closes.alias("window_closes_at_utc"),
        (ntz(as_of) >= closes).alias("is_window_closed"),
        "pay_timestamp_utc",
        "currency",
        "amount_local",
        F.col("pay_timestamp_utc").isNotNull().alias("is_paid_post_call"),
    )
