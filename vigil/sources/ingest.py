"""Exactly-once ingest of landing files into a table.

A Structured Streaming file source with ``trigger(availableNow=True)``: the
checkpoint records which files were committed, so a re-run reads only new
files and a crashed run resumes without double-loading. Each micro-batch
is appended with the batch id recorded; a replayed batch overwrites its own
partition (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_files(spark: SparkSession, source_dir: str, target_dir: str, checkpoint: str,
               schema: T.StructType, fmt: str = "csv", options: dict | None = None,
               max_files_per_trigger: int | None = None, key: str = "_mirror_row_id"):
    """Start (and return) an availableNow ingest; call ``awaitTermination``. Each batch leaves its log beside the table: for
    each file its rows and the sum of its ``key`` (a key that is no whole number adds nothing)."""
    r = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.load(source_dir).withColumn("_source_file", F.col("_metadata.file_path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        path = f"{target_dir}/batch={batch_id:020d}"
        loaded = batch.withColumn("_batch_id", F.lit(batch_id).cast("long")).withColumn("_loaded_at", F.current_timestamp())
        loaded.write.mode("overwrite").parquet(path)
        written = spark.read.schema(loaded.schema).parquet(path)  # three columns of what this batch has just written
        keys = F.sum(F.col(key).cast("string").try_cast("decimal(38,0)")) if key in written.columns else F.lit(None).cast("decimal(38,0)")
        log = written.groupBy(F.col("_source_file").alias("file"), "_batch_id").agg(F.count(F.lit(1)).alias("rows"), keys.alias("keys"), F.max("_loaded_at").alias("loaded_at"))
        log.write.mode("overwrite").parquet(f"{_log_dir(target_dir)}/batch={batch_id:020d}")

    return (src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _log_dir(target_dir: str) -> str:
    return f"{target_dir.rstrip('/')}_log"


def load_log(spark: SparkSession, target_dir: str) -> DataFrame:
    """What was loaded: for each file its rows, the sum of its keys, the batch and the time; the table is not read."""
    return spark.read.schema("file string, _batch_id long, rows long, keys decimal(38,0), loaded_at timestamp").parquet(_log_dir(target_dir))


def csv_options() -> dict:
    """CSV options that keep NULL and '' apart (see tables.read_raw_csv)."""
    return {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
