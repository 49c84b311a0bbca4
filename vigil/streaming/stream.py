"""Structured Streaming jobs: CDC apply loop and streaming rules.

``run_stream`` reads change files as they land, decodes and coerces them once, and in ``foreachBatch`` commits each
micro-batch to the mirror's ledger (see ``mirror``): its compacted changes, counts and quarantine become visible together or
not at all, and a replayed batch (at-least-once delivery after a failure) changes nothing. Changes are ordered by the struct
(batch, file, record, part): any number of files, records and batches. ``current`` is merge-on-read: the last version's
buckets and the batches behind it, or seed and feed where no version has been made. Progress lives in the streaming checkpoint.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rules as R
from ..operators import silver
from . import cdc, mirror

ORDER = "struct<batch:bigint,file:string,pos:int,part:int>"


def read_lines_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Whole files as they land; one row per record with its position. A file is one value, so the writer must
    rotate change files well below 2 GB; files are spread over tasks."""
    r = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(source_dir).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed_at"), "value")
    return df.select("file", "landed_at", F.posexplode(cdc.records(F.col("value"))).alias("pos", "value"))


def run_stream(spark: SparkSession, source_dir: str, target_dir: str, checkpoint: str,
               target: T.StructType, key: str, schema_name: str | None = None, table_name: str | None = None,
               trigger: str = "availableNow", max_files_per_trigger: int | None = None, buckets: int = 64, numbered: bool = False):
    """Start the CDC apply stream; returns the StreamingQuery. ``buckets`` is that of the mirror's versions. ``numbered``:
    change files are named by numbers without gaps; a missing one is an error before anything is read."""
    if numbered:
        mirror.check_landing(spark, target_dir, source_dir)
    lines = read_lines_stream(spark, source_dir, max_files_per_trigger)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        read = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        commit_lines(spark, target_dir, batch_id, read, target, key, schema_name, table_name, buckets, numbered)

    w = lines.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()


def _source(read: DataFrame, numbered: bool) -> tuple[dict, int | None]:
    """What a batch is made from, for the ledger, and when its last line landed. The lines need not be parsed for it."""
    number = F.regexp_extract("file", r"([0-9]+)\.[^/]*$", 1).try_cast("long")
    seen = read.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("file").alias("files"), F.sum(F.xxhash64("file", "pos", "value").cast("decimal(38,0)")).alias("hash"),
                    F.max(F.unix_millis("landed_at")).alias("landed"), F.min(number).alias("first"), F.max(number).alias("last")).first()
    source = {"records": seen.records, "files": seen.files, "hash": str(seen["hash"])} | ({"first": seen["first"], "last": seen["last"]} if numbered else {})
    return source, seen.landed


def commit_lines(spark: SparkSession, target_dir: str, batch_id: int, read: DataFrame, target: T.StructType, key: str,
                 schema_name: str | None, table_name: str | None, buckets: int, numbered: bool = False) -> str:
    """Commit one batch of records of columns ``batch, file, landed_at, pos, value``. A batch that the ledger refuses or has
    is not parsed; any other is parsed once, and its parts are made from that."""
    mirror.check_gap(spark, target_dir, batch_id)
    source, landed = _source(read, numbered)
    if not mirror.admit(spark, target_dir, batch_id, source):
        return "replayed"
    parsed = cdc.parse(read).persist(StorageLevel.DISK_ONLY)
    try:
        return _commit(spark, target_dir, batch_id, parsed, read.columns, target, key, schema_name, table_name, buckets, source, landed)
    finally:
        parsed.unpersist()


def commit_parsed(spark: SparkSession, target_dir: str, batch_id: int, parsed: DataFrame, columns: list[str], target: T.StructType, key: str,
                  schema_name: str | None, table_name: str | None, buckets: int, numbered: bool = False) -> str:
    """``commit_lines`` for records that ``cdc.parse`` has read."""
    mirror.check_gap(spark, target_dir, batch_id)
    source, landed = _source(parsed, numbered)
    if not mirror.admit(spark, target_dir, batch_id, source):
        return "replayed"
    return _commit(spark, target_dir, batch_id, parsed, columns, target, key, schema_name, table_name, buckets, source, landed)


def _commit(spark: SparkSession, target_dir: str, batch_id: int, parsed: DataFrame, columns: list[str], target: T.StructType, key: str,
            schema_name: str | None, table_name: str | None, buckets: int, source: dict, landed: int | None) -> str:
    keep = [c for c in columns if c != "value"]
    seq = F.struct("batch", "file", "pos", "part").cast(ORDER).alias("seq")
    decoded = cdc.decode_parsed(parsed, keep).withColumn("seq", seq)
    typed = cdc.coerce(decoded, target, schema_name, table_name, keep=("seq", "landed_at"), unchanged=True).persist(StorageLevel.DISK_ONLY)
    changes = cdc.compact(typed, key, "seq").select(*[f.name for f in mirror.feed_schema(target, ORDER).fields])
    named = cdc.bad_keys(typed, key).select("seq", F.to_json(F.struct(*target.names)).alias("value"), "reason")
    lost = cdc.quarantine_parsed(parsed.withColumn("part", F.lit(0)), [*keep, "part"]).select(seq, "value", "reason")
    stats = cdc.batch_stats(cdc.good_keys(typed, key)).withColumn("batch_id", F.lit(batch_id).cast("long"))
    try:
        touched = [r.b for r in cdc.good_keys(typed, key).select(mirror.bucket_of(key, buckets).alias("b")).distinct().collect()]  # at most `buckets`
        return mirror.commit(spark, target_dir, batch_id, {"changes": changes, "stats": stats, "quarantine": lost.unionByName(named)}, source,
                             buckets=sorted(touched), n_buckets=buckets, landed=landed)
    finally:
        typed.unpersist()


def changes(spark: SparkSession, target_dir: str, target: T.StructType) -> DataFrame:
    """The change feed of all committed batches; empty if there is none. Any other failure is raised."""
    return mirror.read_part(spark, target_dir, "changes", mirror.feed_schema(target, ORDER))


def quarantine(spark: SparkSession, target_dir: str) -> DataFrame:
    return mirror.read_part(spark, target_dir, "quarantine", T.StructType.fromDDL(f"seq {ORDER}, value string, reason string"))


def stats(spark: SparkSession, target_dir: str) -> DataFrame:
    return mirror.read_part(spark, target_dir, "stats", T.StructType.fromDDL("inserts long, updates long, deletes long, upserts long, batch_id long"))


def high_water(spark: SparkSession, target_dir: str, target: T.StructType) -> DataFrame:
    """The last change in the feed, read from the newest batch alone: one row with its order, and the batch's changes."""
    known = mirror.ledger(spark, target_dir)
    after = known[-1]["batch"] - 1 if known else -1
    ch = mirror.read_part(spark, target_dir, "changes", mirror.feed_schema(target, ORDER), after)
    return ch.agg(F.max("seq").alias("last"), F.count("*").alias("changes")).withColumn("batches", F.lit(len(known)))


def current(spark: SparkSession, seed_df: DataFrame, target_dir: str, target: T.StructType, key: str) -> DataFrame:
    """Merge-on-read view of the mirror; ``seed_df`` is what it starts from where no version has been made."""
    if mirror.versions(spark, target_dir):
        return mirror.current(spark, target_dir, target, key, ORDER)
    ch = changes(spark, target_dir, target).drop("landed_at")
    return cdc.current_view(seed_df.select(*[f.name for f in target.fields]), ch, key)


def history(spark: SparkSession, target_dir: str, target: T.StructType, retain_days: int = 7) -> DataFrame:
    """The change feed of the last ``retain_days`` before the newest change, with ``landed_at``."""
    return cdc.history(changes(spark, target_dir, target), "landed_at", retain_days)


# ---------------------------------------------------------------- X1 - X3

STATELESS_RULES = [r for r in R.RULES if r.rule_id in ("R02", "R07", "R09")]


def stream_rules(raw_stream: DataFrame) -> DataFrame:
    """Silver + the rules that need no history, on a stream."""
    s = silver.build(raw_stream).withColumn("txn_hour", F.hour("txn_ts"))
    odd = [r for r in R.RULES if r.rule_id == "R04"]
    return R.flags(s, STATELESS_RULES + odd)


def stream_velocity(silver_stream: DataFrame, watermark: str | None = "2 hours") -> DataFrame:
    """Transactions per account per clock hour; final when the hour's
    window closes (watermark), so R05 is exact for every row of the hour.
    Without a watermark all hours stay open."""
    rows = silver_stream if watermark is None else silver_stream.withWatermark("txn_ts", watermark)
    return (rows.groupBy("account_no", F.window("txn_ts", "1 hour"))
            .agg(F.count(F.lit(1)).alias("acct_txns_same_hour"))
            .withColumn("velocity", F.col("acct_txns_same_hour") >= R.VELOCITY_MIN))


def stream_dedup(silver_stream: DataFrame, watermark: str = "1 day",
                 keys=("txn_id", "txn_amount", "merchant_name", "txn_ts")) -> DataFrame:
    """Drop exact duplicates that arrive within the watermark."""
    return silver_stream.withWatermark("txn_ts", watermark).dropDuplicatesWithinWatermark(list(keys))
