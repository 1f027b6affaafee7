"""Payment attribution as a stream: who owns each payment, while rows arrive in any order.

Dispositions and payments of a contract meet in its state, which spans the three days a payment can
belong to a disposition and the lateness that is allowed. Every arrival gives the changes it makes:

    opened     a disposition is there
    paid       a payment belongs to a disposition
    retracted  it does so no longer, because a nearer disposition or a smaller copy came later
    closed     no row that is still allowed can change the disposition's payments; their number

Paid less retracted rows of a disposition are its payments at any time, and after its ``closed`` row
for good. A bucket of contracts has one event-time timer, for the first window that closes. When it
fires, all dispositions due by the watermark and their payments leave the state, and so does a payment without an owner once no earlier disposition can
come. Rows behind the watermark are dropped, as the daily job's lookback repairs those.

Contracts are dealt by hash into buckets, which are the keys of the state. The window and the lateness
of a bucket are held by one task and written anew by each batch that touches it, so there should be
enough of them. A contract has one bucket; the batch route (``operators/attribution.py``) splits
contracts that are larger.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from callscope.functions import from_micros, micros, ntz, window_close
from callscope.functions.times import ATTRIBUTION_DAYS
from callscope.operators.attribution import assessable_dispositions, recoverable_payments

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_WINDOW = ATTRIBUTION_DAYS * 86_400_000_000
_CHANGES = (
    "contract_id bigint, change string, call_log_id bigint, market string, disposed_us bigint, "
    "paid_us bigint, currency string, amount_local double, payments bigint"
)
_COLUMNS = [c.split()[0] for c in _CHANGES.split(", ")]


_ARRIVAL = ("contract_id", "us", "call_log_id", "market", "currency", "amount_local")
# Of calls and of payments, a list per column.
_KEPT = (
    "of_call array<bigint>, ids array<bigint>, ats array<bigint>, markets array<string>, "
    "of_payment array<bigint>, paid array<bigint>, amounts array<double>, currencies array<string>, owners array<bigint>"
)
# Contracts that share a bucket where their number is known.
CONTRACTS_PER_BUCKET = 64


def _after(us: int) -> int:
    """The first millisecond that is not before a microsecond."""
    return -(-us // 1000)


def _due(contracts: dict) -> int | None:
    """When the first call closes or the first payment without an owner can leave, in milliseconds."""
    ends = [at + _WINDOW for calls, _ in contracts.values() for at, _ in calls.values()]
    ends += [at for _, payments in contracts.values() for (at, _), (_, _, owned) in payments.items() if not owned]
    return _after(min(ends)) if ends else None


class PaymentOwners(StatefulProcessor):
    """The calls and payments of a bucket of contracts that can still change.

    They are one value with a list per column, read and written once per batch, and have one timer,
    for the first of them that can leave: what a batch costs in calls of the state store goes by the
    buckets it touches, not by rows, timers or contracts. An owner of -1 is none. A currency that is
    not known is '~', which comes after the others, and a market ''.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", _KEPT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        contracts = self._load()
        timer = _due(contracts)
        out: list[tuple] = []
        fresh = set()
        for batch in rows:
            for contract, at, call, market, currency, amount in zip(*(batch[c].tolist() for c in _ARRIVAL), strict=True):
                fresh.add(contract)
                calls, payments = contracts[contract]
                if call >= 0:
                    if call not in calls:
                        out.append((contract, "opened", call, market, at, None, None, None, None))
                    calls[call] = (at, market)
                elif (at, amount) not in payments or currency < payments[at, amount][0]:
                    if (at, amount) in payments and payments[at, amount][2]:
                        out.append(self._told(contract, "retracted", calls, (at, amount), payments[at, amount]))
                    payments[at, amount] = (currency, -1, False)
        for contract in fresh:
            out += self._owned(contract, *contracts[contract])
        self._keep(contracts)
        due = _due(contracts)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Lets go of all that is due by the watermark, not only of what the timer was set for."""
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        contracts = self._load()
        out = []
        for contract, (calls, payments) in contracts.items():
            closed = {c: 0 for c, (at, _) in calls.items() if _after(at + _WINDOW) <= now}
            for pay, (_, owner, owned) in list(payments.items()):
                if owned and owner in closed:
                    closed[owner] += 1
                if owned and owner in closed or not owned and _after(pay[0]) <= now:
                    del payments[pay]
            for call, n in closed.items():
                at, market = calls.pop(call)
                out.append((contract, "closed", call, market, at, None, None, None, n))
        self._keep(contracts)
        due = _due(contracts)
        if due is not None:
            self.handle.registerTimer(due)
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass

    def _load(self) -> defaultdict:
        """Calls and payments by contract."""
        contracts = defaultdict(lambda: ({}, {}))
        of_call, ids, ats, markets, of_payment, paid, amounts, currencies, owners = self.kept.get() or [[]] * 9
        for contract, call, at, market in zip(of_call, ids, ats, markets, strict=True):
            contracts[contract][0][call] = (at, market)
        for contract, at, amount, currency, owner in zip(of_payment, paid, amounts, currencies, owners, strict=True):
            contracts[contract][1][at, amount] = (currency, owner, owner >= 0)
        return contracts

    def _keep(self, contracts: dict) -> None:
        calls = [(c, call, *v) for c, (calls, _) in contracts.items() for call, v in calls.items()]
        payments = [(c, *pay, *v[:2]) for c, (_, payments) in contracts.items() for pay, v in payments.items()]
        if calls or payments:
            columns = ([r[i] for r in rows] for rows, n in ((calls, 4), (payments, 5)) for i in range(n))
            self.kept.update(tuple(columns))
        else:
            self.kept.clear()

    @staticmethod
    def _told(contract: int, change: str, calls: dict, pay: tuple, value: tuple) -> tuple:
        currency, owner, _ = value
        return contract, change, owner, calls[owner][1], calls[owner][0], pay[0], currency, pay[1], None

    def _owned(self, contract: int, calls: dict, payments: dict) -> list[tuple]:
        """Give every payment to the nearest call before it; what that changes."""
        order = sorted((at, call) for call, (at, _) in calls.items())
        out = []
        for pay, value in payments.items():
            i = bisect_right(order, (pay[0], float("inf"))) - 1
            near = order[i] if i >= 0 and pay[0] <= order[i][0] + _WINDOW else None
            owner = near[1] if near else -1
            if (owner, near is not None) == value[1:]:
                continue
            if value[2]:
                out.append(self._told(contract, "retracted", calls, pay, value))
            payments[pay] = (value[0], owner, near is not None)
            if near:
                out.append(self._told(contract, "paid", calls, pay, payments[pay]))
        return out

    @staticmethod
    def _frame(changes: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({c: list(v) for c, v in zip(_COLUMNS, zip(*changes, strict=True), strict=True)}, dtype=object)


def arrivals(dispositions: DataFrame, payments: DataFrame) -> DataFrame:
    """Staging streams, or tables, as one kind of row; rows without a contract or time say nothing."""
    calls = assessable_dispositions(dispositions).select(
        "contract_id",
        micros(F.col("disposed_at_utc")).alias("us"),
        "call_log_id",
        F.coalesce("market", F.lit("")).alias("market"),
        F.lit("~").alias("currency"),
        F.lit(0.0).alias("amount_local"),
    )
    paid = recoverable_payments(payments).select(
        "contract_id",
        micros(F.col("pay_timestamp_utc")).alias("us"),
        F.lit(-1).cast("bigint").alias("call_log_id"),
        F.lit("").alias("market"),
        F.coalesce("currency", F.lit("~")).alias("currency"),
        "amount_local",
    )
    return calls.unionByName(paid).filter(F.col("us").isNotNull())


def buckets_for(contracts: int) -> int:
    return max(8, -(-contracts // CONTRACTS_PER_BUCKET))


def owner_changes(arriving: DataFrame, lateness: str, buckets: int = 4096) -> DataFrame:
    """The stream of changes that the stream of ``arrivals`` makes.

    ``lateness`` is how far behind the latest time seen a row may be, like ``"2 days"``. ``buckets``
    stays as it is for the life of a checkpoint. Needs the state store ``PROVIDER``. A disposition id
    is not negative and occurs once.
    """
    bucket = F.pmod(F.xxhash64("contract_id"), F.lit(buckets))
    marked = arriving.withColumns({"bucket": bucket, "seen_at": F.timestamp_micros("us")})
    changes = marked.withWatermark("seen_at", lateness).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=PaymentOwners(), outputStructType=_CHANGES, outputMode="Append", timeMode="EventTime"
    )
    return changes.select(
        "contract_id",
        "change",
        "call_log_id",
        F.nullif("market", F.lit("")).alias("market"),
        from_micros(F.col("disposed_us")).alias("disposed_at_utc"),
        from_micros(F.col("paid_us")).alias("pay_timestamp_utc"),
        F.nullif("currency", F.lit("~")).alias("currency"),
        "amount_local",
        "payments",
    )


def paid_post_call_of(changes: DataFrame, as_of: datetime) -> DataFrame:
    """The mart ``fct_paid_post_call`` from all changes so far."""
    step = F.when(F.col("change") == "paid", 1).when(F.col("change") == "retracted", -1).otherwise(0)
    counted = changes.groupBy("call_log_id", "market", "contract_id", "disposed_at_utc").agg(F.sum(step).alias("n"))
    closes = window_close(F.col("disposed_at_utc"))
    return counted.select(
        "call_log_id",
        "market",
        "contract_id",
        "disposed_at_utc",
        closes.alias("window_closes_at_utc"),
        (ntz(as_of) >= closes).alias("is_window_closed"),
        (F.col("n") > 0).alias("is_paid_post_call"),
        F.col("n").alias("attributed_payment_count"),
    )
