"""Registered queries: rankings, trust by source, concentration by channel, snapshot export, evidence, load log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import rules as R
from ..session import scratch_path
from ..sources import fixtures, ingest, sinks, tables
from . import oracle as O
from .q_quality import JUNK, RAW_TEXT_COLS
from .registry import register

ID = "_mirror_row_id"
_RATE = "100.0 * CAST({} AS DOUBLE) / CAST(count(*) AS DOUBLE)"
_RATES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_RATE.format(f'count(*) FILTER (WHERE {c} IS NULL OR trim({c}) IN ({JUNK}))')} AS mess_pct FROM raw_txn" for c in RAW_TEXT_COLS)
HIGHEST, LOWEST = 12, 5


@register("mess_ranking", O.sql(f"""
SELECT column_name, round(mess_pct, 6) AS mess_pct, round((SELECT avg(mess_pct) FROM rates), 6) AS mean_pct, place FROM (
  SELECT *, row_number() OVER (ORDER BY mess_pct DESC, column_name) AS place, count(*) OVER () AS n FROM rates)
WHERE place <= {HIGHEST} OR place > n - {LOWEST}""".replace("SELECT column_name, round", f"WITH rates AS ({_RATES}) SELECT column_name, round", 1), "raw_txn"))
def q_mess_ranking(c):
    """H5: the columns with the highest and the lowest share of look-alikes, and the mean (a row for each column)."""
    rates = Q.mess_rates(c.raw(), RAW_TEXT_COLS)
    ranked = Q.ranked(rates, "mess_pct", "column_name")
    return ranked.filter((F.col("place") <= HIGHEST) | (F.col("place") > F.col("n") - LOWEST)).select(
        "column_name", F.round("mess_pct", 6).alias("mess_pct"), F.round("mean", 6).alias("mean_pct"), "place")


@register("trust_by_source", O.sql(f"""
SELECT source_system, count(*) AS rows, round({_RATE.format('count(txn_ts)')}, 6) AS pct_with_time, round({_RATE.format('count(txn_amount)')}, 6) AS pct_with_amount,
       CAST(sum(copies - 1) AS BIGINT) AS surplus_rows
FROM (SELECT source_system, txn_ts, txn_amount, CASE WHEN row_number() OVER (PARTITION BY source_system, txn_id ORDER BY _mirror_row_id) > 1 AND txn_id IS NOT NULL THEN 2 ELSE 1 END AS copies FROM silver)
GROUP BY source_system""", "silver"))
def q_trust_by_source(c):
    """Recovery and duplicates by the system that sent the row."""
    return Q.trust(c.silver(), "source_system", {"pct_with_time": "txn_ts", "pct_with_amount": "txn_amount"}, "txn_id")


@register("channel_concentration", O.sql("""
SELECT d.channel, CAST(sum(f.txn_amount) AS DOUBLE) AS amount,
       round(100.0 * CAST(sum(f.txn_amount) AS DOUBLE) / CAST((SELECT sum(txn_amount) FROM fact_transaction) AS DOUBLE), 6) AS share_pct
FROM fact_transaction f JOIN dim_channel d USING (channel_key) GROUP BY d.channel""", "fact_transaction", "dim_channel"))
def q_channel_concentration(c):
    """Exposure by channel."""
    f = c.table("fact_transaction")
    by_key = f.groupBy("channel_key").agg(F.sum("txn_amount").alias("a"))
    total = by_key.agg(F.sum("a").alias("__total"))
    by = by_key.join(c.table("dim_channel").select("channel_key", "channel"), "channel_key").groupBy("channel").agg(F.sum("a").alias("amount"))
    share = F.round(F.lit(100.0) * F.col("amount").cast("double") / F.col("__total").cast("double"), 6)
    return by.crossJoin(F.broadcast(total)).select("channel", F.col("amount").cast("double").alias("amount"), share.alias("share_pct"))  # one row


@register("rules_ranked", O.sql("""
SELECT rule_id, rule_name, CAST(weight AS BIGINT) AS weight, count(a.weight) AS firings, rank() OVER (ORDER BY count(a.weight) DESC, rule_id) AS place
FROM dim_risk_rule LEFT JOIN (SELECT rule_id, weight FROM fact_alert) a USING (rule_id) GROUP BY rule_id, rule_name, dim_risk_rule.weight""".replace("CAST(weight", "CAST(dim_risk_rule.weight"), "dim_risk_rule", "fact_alert"))
def q_rules_ranked(c):
    """The rules by firings, with their weights (a row for each rule)."""
    n = c.table("fact_alert").groupBy("rule_id").agg(F.count(F.lit(1)).alias("firings"))
    x = c.table("dim_risk_rule").select("rule_id", "rule_name", "weight").join(n, "rule_id", "left").withColumn("firings", F.coalesce("firings", F.lit(0)))
    return Q.ranked(x, "firings", "rule_id").select("rule_id", "rule_name", "weight", "firings", "place")


@register("retired_rules", O.sql(f"""
SELECT {ID}, coalesce(txn_currency <> account_currency, FALSE) AS cross_border, coalesce(txn_amount % 100 = 0 AND txn_amount <> 0, FALSE) AS round_amount FROM silver""", "silver"))
def q_retired_rules(c):
    """Rules that are available but not in the score; a NULL condition is FALSE."""
    return R.flags(c.silver(), R.RETIRED).select(ID, *[r.name for r in R.RETIRED])


@register("snapshot_export", O.sql(f"SELECT {ID}, rule_id, CAST(weight AS BIGINT) AS weight FROM fact_alert", "fact_alert"))
def q_snapshot_export(c):
    """A snapshot written in parallel as zstd and read back, row by row."""
    path = scratch_path(c.spark, "snapshot")
    sinks.export_snapshot(c.table("fact_alert"), path)
    return c.spark.read.parquet(path).select(ID, "rule_id", "weight")


@register("run_evidence", O.sql("""
SELECT 'fact_alert' AS metric, CAST(count(*) AS BIGINT) AS value FROM fact_alert
UNION ALL SELECT 'fact_transaction', count(*) FROM fact_transaction UNION ALL SELECT 'rules_fired', CAST(sum(rules_fired) AS BIGINT) FROM fact_transaction""", "fact_alert", "fact_transaction"))
def q_run_evidence(c):
    """Run metrics as JSON, read back."""
    t, a = c.table("fact_transaction"), c.table("fact_alert")
    rows = a.agg(F.lit("fact_alert").alias("metric"), F.count(F.lit(1)).alias("value")).unionByName(
        t.agg(F.lit("fact_transaction").alias("metric"), F.count(F.lit(1)).alias("value"))).unionByName(
        t.agg(F.lit("rules_fired").alias("metric"), F.sum("rules_fired").cast("long").alias("value")))
    path = scratch_path(c.spark, "evidence")
    sinks.write_evidence(rows, path)
    return c.spark.read.schema("metric string, value long").json(path)


@register("load_log", O.sql(f"SELECT {ID} % 4 AS part, count(*) AS rows, CAST(sum({ID}) AS BIGINT) AS keys, TRUE AS timed FROM raw_txn GROUP BY 1", "raw_txn"))
def q_load_log(c):
    """The load log: for each landed file its rows and the time of its load, from two runs over growing input."""
    base = scratch_path(c.spark, "load")
    raw = c.raw().withColumn("part", F.col(ID) % 4)
    schema = tables.all_text_schema(list(fixtures.RAW_COLUMNS))
    for part in (0, 1, 2, 3):  # files named by what they hold
        sinks.write_raw_csv(raw.filter(F.col("part") == part).drop("part"), f"{base}/landing/part={part}")
        if part in (1, 3):
            ingest.load_files(c.spark, f"{base}/landing/part=*", f"{base}/table", f"{base}/ckpt", schema, "csv", ingest.csv_options()).awaitTermination()
    log = ingest.load_log(c.spark, f"{base}/table")
    return log.groupBy(F.regexp_extract("file", "part=([0-9])", 1).cast("long").alias("part")).agg(
        F.sum("rows").alias("rows"), F.sum("keys").cast("long").alias("keys"), F.min(F.col("loaded_at").isNotNull()).alias("timed"))


@register("probe_rows", O.sql(f"""
SELECT {ID}, txn_id FROM silver WHERE txn_id IN (SELECT txn_id FROM silver GROUP BY txn_id HAVING count(*) = 1) ORDER BY {ID} LIMIT 2""", "silver"))
def q_probe_rows(c):
    """rows to follow through a change feed."""
    return Q.probe_rows(c.silver()).select(ID, "txn_id")
