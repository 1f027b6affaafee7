"""Owners of payments from a stream: after any arrival order the answers of the batch route."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callscope.functions import from_micros, micros
from callscope.operators.attribution import attribute_payments, with_window_state
from callscope.plans import marts
from callscope.session import shared_folder
from callscope.streaming import owners

DISPOSITION = "call_log_id bigint, market string, contract_id bigint, disposed_at_utc timestamp_ntz"
PAYMENT = "contract_id bigint, pay_timestamp_utc timestamp_ntz, currency string, amount_local double"
ARRIVAL = "contract_id bigint, us bigint, call_log_id bigint, market string, currency string, amount_local double"
START = datetime(2024, 1, 1)
AS_OF = datetime(2024, 2, 1)
_DAY = 86_400_000_000


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, owners.PROVIDER)
    yield
    spark.conf.set(key, old)


def random_rows(rng):
    def moment():
        return START + timedelta(minutes=rng.randrange(0, 20 * 1440, rng.choice([1, 60, 1440])), microseconds=rng.choice([0, 1, 999]))

    calls = [(i, rng.choice(["Kenya", None]), rng.choice([None, 1, 1, 1, 2, 3]), moment()) for i in range(90)]
    paid = [(rng.choice([None, 1, 1, 2, 3, 4]), moment(), rng.choice(["KES", "UGX", None]), float(rng.randrange(-1, 4))) for _ in range(140)]
    return calls, paid + rng.sample(paid, 20)


def run(spark, batches, lateness):
    """Changes of batches that arrive one after the other, and rows left in the state."""
    base = shared_folder(spark, "owners")
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.parquet(f"{base}/in/{i:03}")
        for name in os.listdir(f"{base}/in/{i:03}"):  # files are taken by time, which has seconds here
            os.utime(f"{base}/in/{i:03}/{name}", (1.7e9 + i, 1.7e9 + i))
    source = spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    query = (
        owners.owner_changes(source.parquet(f"{base}/in"), lateness)
        .writeStream.option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{base}/out")
    )
    query.awaitTermination()
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    return spark.read.parquet(f"{base}/out"), left


def end(spark):
    """A row far ahead, of a contract of its own, with which all windows close; it stays."""
    at = int((datetime(2024, 6, 1) - datetime(1970, 1, 1)).total_seconds()) * 10**6
    return spark.createDataFrame([(-1, at, -1, "", "~", 1.0)], ARRIVAL)


@pytest.mark.parametrize("seed", range(2))
def test_any_order_inside_the_lateness(spark, rocksdb, seed):
    rng = random.Random(seed)
    calls, paid = random_rows(rng)
    d, p = spark.createDataFrame(calls, DISPOSITION), spark.createDataFrame(paid, PAYMENT)
    rows = [tuple(r) for r in owners.arrivals(d, p).collect()]
    rows.sort(key=lambda r: r[1] + rng.randrange(2 * 86_400_000_000))
    cuts = sorted(rng.sample(range(1, len(rows)), 5))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
    changes, left = run(spark, [*(spark.createDataFrame(x, ARRIVAL) for x in parts), end(spark)], "2 days 1 second")
    wanted = marts.fct_paid_post_call(with_window_state(attribute_payments(d, p), AS_OF)).filter("disposed_at_utc is not null")
    found = owners.paid_post_call_of(changes, AS_OF)
    assert found.columns == wanted.columns
    assert sorted(found.collect(), key=repr) == sorted(wanted.collect(), key=repr)
    closed = {r.call_log_id: r.payments for r in changes.filter("change = 'closed'").collect()}
    assert closed == {r.call_log_id: r.attributed_payment_count for r in wanted.collect()}
    # the winners themselves, copies once
    signed = changes.filter("change in ('paid', 'retracted')").withColumn("step", F.expr("if(change = 'paid', 1, -1)"))
    keys = ("call_log_id", "pay_timestamp_utc", "currency", "amount_local")
    winners = signed.groupBy(*keys).agg(F.sum("step").alias("n")).filter("n <> 0")
    attributed = attribute_payments(d, p).filter("pay_timestamp_utc is not null").select(*keys, F.lit(1).alias("n"))
    assert sorted(winners.collect(), key=repr) == sorted(attributed.collect(), key=repr)
    assert left <= 3  # the last row, its key and its timer


def test_later_call_takes_the_payment_back(spark, rocksdb):
    hour = 3_600_000_000
    first = [(1, _DAY, 10, "Kenya", "~", 0.0), (1, _DAY + 5 * hour, -1, "", "UGX", 2.0)]
    second = [(1, _DAY + 3 * hour, 11, "Kenya", "~", 0.0), (1, _DAY + 5 * hour, -1, "", "KES", 2.0)]
    changes, _ = run(spark, [spark.createDataFrame(x, ARRIVAL) for x in (first, second)], "2 days")
    found = [(r.change, r.call_log_id, r.currency) for r in changes.collect()]
    assert sorted(found, key=repr) == sorted(
        [("opened", 10, None), ("paid", 10, "UGX"), ("opened", 11, None), ("retracted", 10, "UGX"), ("paid", 11, "KES")], key=repr
    )


def test_late_rows_are_dropped(spark, rocksdb):
    late = (1, 2 * _DAY, -1, "", "KES", 2.0)
    # a batch filters by the watermark of the one before
    parts = [[(c, day * _DAY, call, "Kenya", "~", 0.0)] for c, day, call in ((1, 1, 10), (2, 10, 20), (2, 10, 21))] + [[late]]
    changes, _ = run(spark, [spark.createDataFrame(x, ARRIVAL) for x in parts], "1 day")
    assert {(r.change, r.call_log_id) for r in changes.collect()} == {
        ("opened", 10), ("closed", 10), ("opened", 20), ("opened", 21)
    }


def test_micros_and_back(spark):
    df = spark.sql("select explode(array(timestamp_ntz '1969-12-31 23:59:59.999999', timestamp_ntz '2024-03-10 02:30:15.000001')) as t")
    rows = df.select("t", micros(F.col("t")).alias("us"), from_micros(micros(F.col("t"))).alias("back")).collect()
    assert [r.us for r in rows] == [-1, 1710037815000001] and all(r.t == r.back for r in rows)


def test_state_goes_by_contracts_not_by_rows(spark, rocksdb):
    rows = [(c, day, call, "Kenya", "~", 0.0) for c in range(20) for day in range(30) for call in [c * 100 + day]]
    changes, left = run(spark, [spark.createDataFrame([(c, _DAY + i, *r) for c, i, *r in rows], ARRIVAL)], "2 days")
    assert changes.count() == len(rows)
    assert left <= 3 * 20  # a value and a timer, which is kept by key and by time


def test_contracts_of_one_bucket_are_apart(spark, rocksdb):
    rng = random.Random(5)
    rows = [(c, _DAY * rng.randrange(1, 9) + i, 50 * c + i if i % 2 else -1, "", "KES", 1.0 + i) for c in range(9) for i in range(40)]
    split = [spark.createDataFrame(rows[i::3], ARRIVAL) for i in range(3)]
    base = shared_folder(spark, "owners")
    for part in split:
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    found = []
    for buckets in (1, 500):
        source = spark.readStream.schema(ARRIVAL).parquet(f"{base}/in")
        stream = owners.owner_changes(source, "30 days", buckets).writeStream.option("checkpointLocation", f"{base}/checkpoint{buckets}")
        stream.trigger(availableNow=True).format("parquet").start(f"{base}/out{buckets}").awaitTermination()
        found.append(sorted(map(tuple, spark.read.parquet(f"{base}/out{buckets}").collect()), key=repr))
    assert found[0] == found[1] and len(found[0]) > len(rows) // 2
