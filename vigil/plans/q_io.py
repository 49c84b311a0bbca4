"""Registered queries: sources and sinks (A)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import fixtures, ingest, sinks, tables
from . import oracle as O
from .registry import register

RAW = fixtures.RAW_COLUMNS


def _scratch(spark, name):
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/vigil-{name}-{uuid.uuid4().hex[:12]}"


@register("csv_roundtrip", O.sql(f"SELECT {', '.join(RAW)} FROM raw_txn", "raw_txn"))
def q_csv_roundtrip(c):
    """A6 then A3: NULL and '' survive a CSV round trip unchanged."""
    path = _scratch(c.spark, "csv")
    sinks.write_raw_csv(c.raw(), path)
    return tables.read_raw_csv(c.spark, path, RAW).select(*RAW)


@register("ingest_once", O.sql("SELECT count(*) AS ingested_rows, CAST(0 AS BIGINT) AS second_run_rows FROM raw_txn",
                               "raw_txn"))
def q_ingest_once(c):
    """Two ingest runs over the same landing files load each row once."""
    spark = c.spark
    base = _scratch(spark, "ingest")
    sinks.write_raw_csv(c.raw(), f"{base}/landing")  # a file a task: none grows with the table
    schema = tables.all_text_schema(RAW)
    counts = []
    for _ in range(2):
        q = ingest.load_files(spark, f"{base}/landing", f"{base}/table", f"{base}/ckpt", schema, "csv",
                              ingest.csv_options())
        q.awaitTermination()
        p = q.lastProgress
        counts.append(int(p["numInputRows"]) if p else 0)
    loaded = spark.read.parquet(f"{base}/table")
    return loaded.agg(F.count(F.lit(1)).alias("ingested_rows")).withColumn(
        "second_run_rows", F.lit(counts[1]).cast("long"))


@register("publish_marker", O.sql("SELECT count(*) AS rows FROM fact_alert", "fact_alert"))
def q_publish_marker(c):
    """A10: data first, then the key metadata; readers require both."""
    path = _scratch(c.spark, "publish")
    sinks.publish(c.table("fact_alert"), path, ["_mirror_row_id", "rule_id"])
    return sinks.read_published(c.spark, path).agg(F.count(F.lit(1)).alias("rows"))


@register("gold_export", O.sql("SELECT count(*) AS rows, CAST(sum(txn_amount) AS DOUBLE) AS amount "
                               "FROM fact_transaction", "fact_transaction"))
def q_gold_export(c):
    """Zstd gold export with instant timestamps, read back."""
    base = _scratch(c.spark, "gold")
    paths = sinks.export_gold({"fact_transaction": c.table("fact_transaction")}, base)
    back = c.spark.read.parquet(paths["fact_transaction"])
    return back.agg(F.count(F.lit(1)).alias("rows"), F.sum("txn_amount").alias("amount"))


@register("link_table", O.sql("SELECT count(*) AS rows FROM dim_customer", "dim_customer"))
def q_link_table(c):
    """A named pointer to existing files (no copy)."""
    name = "vigil_link_" + uuid.uuid4().hex[:8]
    return tables.link_table(c.spark, name, c.folder("dim_customer")).agg(F.count(F.lit(1)).alias("rows"))


@register("sample_fraction", None)
def q_sample_fraction(c):
    """Bernoulli sample (the sample is the feature)."""
    return tables.sample_rows(c.raw(), fraction=0.1).select("_mirror_row_id", "txn_id")


@register("sample_n", None)
def q_sample_n(c):
    """Exactly n rows chosen by a stable hash of the key."""
    return tables.sample_rows(c.raw(), n=100).select("_mirror_row_id", "txn_id")


@register("save_gold_layout", None)
def q_save_gold_layout(c):
    """Layout-optimised table; evidence read from its properties."""
    name = "vigil_fact_" + uuid.uuid4().hex[:8]
    sinks.save_gold(c.table("fact_transaction"), name, ["date_key", "_mirror_row_id"], build_id="r1")
    return sinks.layout_evidence(c.spark, name)
