"""Stream operators with state of their own: windows that close once (X2) and first visits to merchants.

Both run on ``transformWithState`` with event time. Spark's own streaming aggregates drop late rows without a trace; here a
late row leaves the stream as a row with ``late``, so what comes out, closed and late together, accounts for all that went in.

State is bounded. A window's count is dropped when the window closes. A customer keeps the rows that the watermark has not
passed, fewer than ``NEW_MERCHANT_MIN_HISTORY`` undecided first visits, one count, and one entry for each merchant visited.
Keys are spread by Spark; each task counts the rows of an account's hour before they move, so an hour with very many rows
costs one row a batch of rows. A customer's rows meet in order in one task, as a first visit
depends on all earlier ones; only ids, merchants and times are kept of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators import rules as R
from ..session import ship

HOUR_MS, TICK_MS = 3_600_000, 60_000


def use_state(spark: SparkSession) -> None:
    """Keyed state lives on the executors' disks, with its changes in the checkpoint; ``transformWithState`` asks for that.
    The processors' code goes along."""
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


# --- X2 ---

class ClosingCounts(StatefulProcessor):
    """Counts of an account's open hours. A batch of rows costs an account one call for its hours and one timer, that of the
    first hour to end; when a timer fires, all hours that the watermark has passed are closed."""

    def init(self, handle) -> None:
        self.handle = handle
        self.hours = handle.getListState("hours", "hour_ms long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed, counts = timerValues.getCurrentWatermarkInMs(), Counter()
        for r in rows:
            counts[r.hour_ms] += r.n
        new = [(h, n) for h, n in counts.items() if h + HOUR_MS > passed]
        if new:
            self.hours.appendList(new)
            self.handle.registerTimer(min(new)[0] + HOUR_MS)
        for h, n in counts.items():
            if h + HOUR_MS <= passed:
                yield Row(account_no=key[0], hour_ms=h, n=n, late=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed, counts = timerValues.getCurrentWatermarkInMs(), Counter()
        for h, n in self.hours.get():
            counts[h] += n
        rest = [(h, n) for h, n in counts.items() if h + HOUR_MS > passed]
        if len(rest) == len(counts):
            return
        if rest:
            self.hours.put(rest)
            self.handle.registerTimer(min(rest)[0] + HOUR_MS)
        else:
            self.hours.clear()
        for h, n in counts.items():
            if h + HOUR_MS <= passed:
                yield Row(account_no=key[0], hour_ms=h, n=n, late=False)

    def close(self) -> None:
        pass


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = pa.table(batch).group_by(["account_no", "hour_ms"]).aggregate([([], "count_all")])
        yield from t.rename_columns(["account_no", "hour_ms", "n"]).to_batches()


def closing_velocity(silver_stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """``account_no, window_start, acct_txns_same_hour, velocity, late``: each hour once, when the watermark passes its
    end; rows that come after that are counted in rows of their own with ``late``."""
    use_state(silver_stream.sparkSession)
    at = F.unix_millis(F.date_trunc("hour", F.col("txn_ts").cast("timestamp")))
    hours = silver_stream.withWatermark("txn_ts", watermark).select("account_no", at.alias("hour_ms"))
    counts = hours.mapInArrow(_counted, "account_no string, hour_ms long, n long").groupBy("account_no")
    out = counts.transformWithState(ClosingCounts(), "account_no string, hour_ms long, n long, late boolean", "append", "eventtime")
    return out.select("account_no", F.timestamp_millis("hour_ms").alias("window_start"), F.col("n").alias("acct_txns_same_hour"), (F.col("n") >= R.VELOCITY_MIN).alias("velocity"), "late")


# --- X4 ---

class FirstVisits(StatefulProcessor):
    """Rows of a customer in order of time and id, once the watermark has passed them."""

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, id long, merchant string")
        self.merchants = handle.getMapState("merchants", "merchant string", "seen boolean")
        self.rows = handle.getValueState("rows", "n long")
        self.undecided = handle.getListState("undecided", "at long, id long, merchant string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed, new = timerValues.getCurrentWatermarkInMs(), []
        for r in rows:
            if r.at < passed:
                yield Row(row_id=r.id, customer_id=key[0], merchant_id=r.merchant, at=r.at, late=True)
            else:
                new.append((r.at, r.id, r.merchant))
        if new:
            self.waiting.appendList(new)
            self._wake(new)

    def _wake(self, rows) -> None:
        """One timer, for the first of the rows: when it fires, all rows that the watermark has passed are taken."""
        self.handle.registerTimer((min(r[0] for r in rows) // TICK_MS + 1) * TICK_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        before = timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(x) for x in self.waiting.get()]
        ready = sorted(x for x in ((a, i, m or "", m is None) for a, i, m in waiting) if x[0] < before)
        if not ready:
            return
        rest = [x for x in waiting if x[0] >= before]
        if rest:
            self.waiting.put(rest)
            self._wake(rest)
        else:
            self.waiting.clear()
        count = (self.rows.get() or (0,))[0]
        undecided = [tuple(x) for x in self.undecided.get()] if count < R.NEW_MERCHANT_MIN_HISTORY else []
        asked = set()  # merchants known to be in the state: one look a timer for each
        for at, row_id, merchant, nowhere in ready:
            count += 1
            if not nowhere and merchant not in asked:
                asked.add(merchant)
                if not self.merchants.containsKey((merchant,)):
                    self.merchants.updateValue((merchant,), (True,))
                    undecided.append((at, row_id, merchant))
            if count >= R.NEW_MERCHANT_MIN_HISTORY:
                for a, i, m in undecided:
                    yield Row(row_id=i, customer_id=key[0], merchant_id=m, at=a, late=False)
                undecided = []
        self.rows.update((count,))
        if undecided:
            self.undecided.put(undecided)
        else:
            self.undecided.clear()

    def close(self) -> None:
        pass


def new_merchants(silver_stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """R06 on a stream: ``row_id, customer_id, merchant_id, txn_ts, late``. A customer's first row at a merchant comes out
    when the customer has ``NEW_MERCHANT_MIN_HISTORY`` rows, as the batch rule has it; rows behind the watermark come out with
    ``late`` and count for nothing. Rows without customer or time are not of this rule: leave them to a side output."""
    use_state(silver_stream.sparkSession)
    rows = silver_stream.withWatermark("txn_ts", watermark).select(
        "customer_id", F.unix_millis(F.col("txn_ts").cast("timestamp")).alias("at"), F.col("_mirror_row_id").alias("id"), F.col("merchant_id").alias("merchant"))
    out = rows.groupBy("customer_id").transformWithState(FirstVisits(), "row_id long, customer_id string, merchant_id string, at long, late boolean", "append", "eventtime")
    return out.select("row_id", "customer_id", "merchant_id", F.timestamp_millis("at").alias("txn_ts"), "late")
