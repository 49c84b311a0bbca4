"""Registered queries: streaming rules (X1) and windowed velocity.

The landing table is written as files and read back with ``readStream``
(``trigger(availableNow=True)``); results land through ``foreachBatch`` in a
folder under the shared checkpoint directory and are read back as a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..streaming import stateful, stream
from . import oracle as O
from .registry import register

ID = "_mirror_row_id"
STREAM_FLAGS = [r.name for r in stream.STATELESS_RULES] + ["odd_hour"]


def _base(spark, name):
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/vigil-{name}-{uuid.uuid4().hex[:12]}"


def _run(c, name, build, mode="append", landing=None):
    """Stream the landing files through ``build`` once; return the result table. ``landing``: where they have been written."""
    spark = c.spark
    base = _base(spark, name)
    landing = landing or _land(c, name)
    src = spark.readStream.schema(c.raw().schema).option("maxFilesPerTrigger", 4).parquet(landing)

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id:020d}")

    q = (build(src).writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _land(c, name):
    path = f"{_base(c.spark, name)}/landing"
    c.raw().write.mode("overwrite").parquet(path)
    return path


@register("stream_rules", O.sql(f"SELECT {ID}, " + ", ".join(STREAM_FLAGS) + " FROM flagged", "flagged"))
def q_stream_rules(c):
    """Silver + the rules that need no history, computed on a stream."""
    out = _run(c, "stream-rules", lambda s: stream.stream_rules(s).select(ID, *STREAM_FLAGS))
    return out.select(ID, *STREAM_FLAGS)


@register("stream_velocity", O.sql("""
SELECT account_no, strftime(date_trunc('hour', txn_ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS acct_txns_same_hour, count(*) >= 2 AS velocity
FROM silver GROUP BY 1, 2""", "silver"))
def q_stream_velocity(c):
    """Per account and clock hour on a stream. A batch emits the hours that
    it changes (update mode), so what is written grows with the rows, not with
    batches times hours. Files arrive in no order of time, so no watermark:
    every hour stays open and its last and greatest count is final after one
    availableNow run; production runs use append (emit on window close)."""
    def build(s):
        from ..operators import silver
        sv = silver.build(s).select("account_no", "txn_ts").filter(F.col("txn_ts").isNotNull())
        return stream.stream_velocity(sv, watermark=None)
    landing = _land(c, "stream-velocity")
    out = _run(c, "stream-velocity", build, mode="update", landing=landing)
    final = out.groupBy("account_no", "window").agg(F.max("acct_txns_same_hour").alias("acct_txns_same_hour"), F.max_by("velocity", "acct_txns_same_hour").alias("velocity"))
    timed = final.select("account_no", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "acct_txns_same_hour", "velocity")
    # Rows without an event time have no window: they go to a side output and form a group for each account.
    side = _untimed(c, "velocity", ["account_no"], landing).groupBy("account_no").agg(F.count(F.lit(1)).alias("acct_txns_same_hour"))
    return timed.unionByName(side.select("account_no", F.lit(None).cast("string").alias("window_start"), "acct_txns_same_hour",
                                         (F.col("acct_txns_same_hour") >= 2).alias("velocity")))


def _untimed(c, name, columns, landing):
    """The side output of a stream: ``columns`` of the silver rows whose event time is NULL."""
    from ..operators import silver
    return _run(c, f"untimed-{name}", lambda s: silver.build(s).filter(F.col("txn_ts").isNull()).select(*columns), landing=landing).select(*columns)


DEDUP_KEYS = ["txn_id", "txn_amount", "merchant_name", "txn_ts"]


@register("stream_dedup", O.sql(
    "SELECT DISTINCT txn_id, CAST(txn_amount AS DOUBLE) AS txn_amount, merchant_name, "
    "strftime(txn_ts, '%Y-%m-%d %H:%M:%S') AS txn_ts FROM silver", "silver"))
def q_stream_dedup(c):
    """Exact duplicates dropped on a stream (state kept for the
    watermark). The fixture's files arrive in random event-time order over
    a month, so the watermark here spans the data; the result is the set of
    distinct business keys (which copy survives is arrival order)."""
    def build(s):
        from ..operators import silver
        sv = silver.build(s).filter(F.col("txn_ts").isNotNull())
        return stream.stream_dedup(sv, watermark="400 days", keys=DEDUP_KEYS).select(*DEDUP_KEYS)
    landing = _land(c, "stream-dedup")
    return _run(c, "stream-dedup", build, landing=landing).select(*DEDUP_KEYS).unionByName(_untimed(c, "dedup", DEDUP_KEYS, landing).distinct())


# --- streams that end their state: slices of time, late rows and a closing row ---

SLICE_DAYS, LATE = 8, 4
COLUMNS = [ID, "txn_id", "txn_ts", "txn_amount", "account_no", "customer_id", "merchant_id", "merchant_name"]


def _slices(c):
    """Timed silver rows by the slice in which they arrive: four stretches of event time in order, but every fiftieth row comes
    behind all of them."""
    s = c.silver().select(*COLUMNS).filter(F.col("txn_ts").isNotNull())
    s = s.withColumn("txn_ts", F.col("txn_ts").cast("timestamp"))
    start = F.broadcast(s.agg(F.min("txn_ts").alias("start")))  # one row
    days = F.floor((F.unix_seconds("txn_ts") - F.unix_seconds("start")) / (SLICE_DAYS * 86_400))
    return s.crossJoin(start).withColumn("slice", F.when(F.col(ID) % 50 == 7, LATE).otherwise(F.least(days, F.lit(LATE - 1)))).drop("start")


def _run_slices(c, name, build):
    """Land slice after slice and run the stream to its end each time; a closing row far ahead lets all state end."""
    spark, base = c.spark, _base(c.spark, name)
    rows = c._get("arrivals", lambda: _slices(c))
    end = rows.agg(F.max("txn_ts").alias("txn_ts")).select((F.col("txn_ts") + F.expr("INTERVAL 30 DAYS")).alias("txn_ts"), F.lit("closing").alias("customer_id"), F.lit("closing").alias("account_no"))
    rows = rows.unionByName(end.withColumn("slice", F.lit(LATE + 1).cast("long")), allowMissingColumns=True)
    queries = []
    for k in range(LATE + 2):
        rows.filter(F.col("slice") == k).drop("slice").write.mode("append").parquet(f"{base}/landing")
        src = spark.readStream.schema(rows.drop("slice").schema).parquet(f"{base}/landing")

        def sink(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id:020d}")

        q = build(src).writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
        queries.append(q)
    return spark.read.parquet(f"{base}/out"), queries


# When a row arrives and whether its time is behind the watermark by then: that is the greatest time of the earlier slices less the delay.
O.extra("arrivals", ["silver"], f"""
SELECT s.*, least(floor(epoch(txn_ts - (SELECT min(txn_ts) FROM silver)) / ({SLICE_DAYS} * 86400)), {LATE - 1}) AS stretch, _mirror_row_id % 50 = 7 AS behind,
       (SELECT max(txn_ts) FROM silver WHERE _mirror_row_id % 50 <> 7) AS newest FROM silver s WHERE txn_ts IS NOT NULL""")


@register("stream_velocity_append", O.sql("""
WITH h AS (SELECT account_no, date_trunc('hour', txn_ts) AS hour, behind AND date_trunc('hour', txn_ts) + INTERVAL 1 HOUR <= newest - INTERVAL 2 HOURS AS late FROM arrivals)
SELECT account_no, strftime(hour, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS acct_txns_same_hour, count(*) >= 2 AS velocity, late FROM h GROUP BY account_no, hour, late""", "arrivals"))
def q_stream_velocity_append(c):
    """X2 in append mode: each hour is emitted once, when the watermark closes it; later rows are counted apart."""
    out, _ = _run_slices(c, "velocity-append", stateful.closing_velocity)
    return out.filter(~F.col("account_no").eqNullSafe("closing")).select("account_no", "window_start", "acct_txns_same_hour", "velocity", "late")


@register("stream_new_merchant", O.sql("""
WITH a AS (SELECT *, behind AND txn_ts < newest - INTERVAL 2 HOURS AS late FROM arrivals WHERE customer_id IS NOT NULL),
f AS (SELECT customer_id, merchant_id, min((txn_ts, _mirror_row_id)) AS visit FROM a WHERE NOT late AND merchant_id IS NOT NULL GROUP BY ALL),
n AS (SELECT customer_id FROM a WHERE NOT late GROUP BY customer_id HAVING count(*) >= 20)
SELECT _mirror_row_id AS row_id, customer_id, merchant_id, strftime(txn_ts, '%Y-%m-%d %H:%M:%S') AS txn_ts, late FROM a
WHERE late OR (customer_id IN (SELECT customer_id FROM n) AND (customer_id, merchant_id, (txn_ts, _mirror_row_id)) IN (SELECT customer_id, merchant_id, visit FROM f))""", "arrivals"))
def q_stream_new_merchant(c):
    """R06 by keyed state: first visits of customers with enough history, and the rows that came too late."""
    out, _ = _run_slices(c, "new-merchant", lambda s: stateful.new_merchants(s.filter(F.col("customer_id").isNotNull())))
    return out.select("row_id", "customer_id", "merchant_id", "txn_ts", "late")


@register("stream_dedup_watermark", O.sql("""
SELECT DISTINCT txn_id, CAST(txn_amount AS DOUBLE) AS txn_amount, merchant_name, strftime(txn_ts, '%Y-%m-%d %H:%M:%S') AS txn_ts
FROM arrivals WHERE NOT (behind AND txn_ts <= newest - INTERVAL 1 DAY)""", "arrivals"))
def q_stream_dedup_watermark(c):
    """X3 with a watermark of a day: keys are forgotten a day on, and what comes later than that is not let in again."""
    out, queries = _run_slices(c, "dedup-watermark", lambda s: stream.stream_dedup(s, keys=DEDUP_KEYS).select(*DEDUP_KEYS, "account_no"))
    left = [p["stateOperators"][0]["numRowsTotal"] for p in queries[-1].recentProgress if p["stateOperators"]]
    if left[-1] > 1:  # the closing row's own key
        raise RuntimeError(f"{left[-1]} keys were not forgotten")
    return out.filter(~F.col("account_no").eqNullSafe("closing")).select(*DEDUP_KEYS)
