"""Registered queries: data quality, reconciliation, verification (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import quality as Q
from ..operators import rules as R
from ..sources import fixtures
from . import oracle as O
from .registry import register

ID = "_mirror_row_id"
RECOVERY_COLS = ["posting_date", "txn_ts", "txn_amount", "kyc_status", "channel", "addr_country",
                 "card_brand", "auth_approved"]
CONFORM_COLS = ["addr_country", "txn_type", "kyc_status", "channel", "card_brand"]
SPELLING_COLS = ["addr_country", "txn_type", "card_brand", "account_currency"]
RAW_TEXT_COLS = [c for c in fixtures.RAW_COLUMNS if c != ID]
FKS = ["date_key", "time_key", "customer_key", "merchant_key", "channel_key", "card_key"]
FK_DIMS = {"date_key": ("dim_date", "date_key"), "time_key": ("dim_time", "time_key"),
           "customer_key": ("dim_customer", "customer_key"), "merchant_key": ("dim_merchant", "merchant_key"),
           "channel_key": ("dim_channel", "channel_key"), "card_key": ("dim_card", "card_key")}
JUNK = ", ".join("'" + j + "'" for j in clean.RAW_JUNK)


def _pct(num, den="count(*)"):
    return f"100.0 * CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"


def _unpivot_sql(table, exprs: dict, value: str, name_col="column_name", ctes=()):
    parts = " UNION ALL ".join(f"SELECT '{k}' AS {name_col}, {e} AS {value} FROM {table}" for k, e in exprs.items())
    return O.sql(parts, table, *ctes)


@register("parse_recovery", _unpivot_sql("silver", {c: _pct(f"count({c})") for c in RECOVERY_COLS}, "pct_non_null"))
def q_parse_recovery(c):
    return Q.recovery(c.silver(), RECOVERY_COLS)


@register("conformance", _unpivot_sql("silver", {c: f"count(DISTINCT {c})" for c in CONFORM_COLS}, "distinct_values"))
def q_conformance(c):
    return Q.conformance(c.silver(), CONFORM_COLS)


@register("dup_profile", O.sql(f"""
SELECT count(*) AS dup_ids, coalesce(sum(c - 1), 0) AS surplus_rows,
       {_pct('coalesce(sum(c - 1), 0)', '(SELECT count(*) FROM raw_txn)')} AS surplus_pct
FROM (SELECT txn_id, count(*) AS c FROM raw_txn WHERE txn_id IS NOT NULL GROUP BY txn_id HAVING count(*) > 1)""",
                               "raw_txn"))
def q_dup_profile(c):
    return Q.duplicates(c.raw(), "txn_id")


@register("mess_rates", _unpivot_sql(
    "raw_txn", {c: _pct(f"count(*) FILTER (WHERE {c} IS NULL OR trim({c}) IN ({JUNK}))") for c in RAW_TEXT_COLS},
    "mess_pct"))
def q_mess_rates(c):
    return Q.mess_rates(c.raw(), RAW_TEXT_COLS)


@register("format_drift", _unpivot_sql(
    "raw_txn", {k: _pct(f"count(*) FILTER (WHERE coalesce(regexp_matches({col}, '{p}'), FALSE))")
                for k, (col, p) in Q.DRIFT_CHECKS.items()}, "pct_parse", "check"))
def q_format_drift(c):
    return Q.format_drift(c.raw())


@register("spellings", O.sql(" UNION ALL ".join(f"""
SELECT column_name, distinct_values, rnk, value, n FROM (
  SELECT '{col}' AS column_name, count(*) OVER () AS distinct_values,
         row_number() OVER (ORDER BY n DESC, value ASC) AS rnk, value, n
  FROM (SELECT {col} AS value, count(*) AS n FROM raw_txn WHERE {col} IS NOT NULL GROUP BY {col}))
WHERE rnk <= 6""" for col in SPELLING_COLS), "raw_txn"))
def q_spellings(c):
    return Q.spellings(c.raw(), SPELLING_COLS, 6)


@register("coherence", O.sql(f"""
SELECT count(*) AS incoherent_customers FROM (
  SELECT customer_id FROM raw_txn
  WHERE customer_id IS NOT NULL AND trim(customer_id) NOT IN ({JUNK})
    AND first_name IS NOT NULL AND trim(first_name) NOT IN ({JUNK})
  GROUP BY customer_id HAVING count(DISTINCT lower(trim(first_name))) > 1)""", "raw_txn"))
def q_coherence(c):
    return Q.coherence(c.raw())


@register("fingerprint", O.sql(f"""
SELECT substr(md5(CAST({ID} AS VARCHAR)), 1, 5) AS bucket, count(DISTINCT {ID}) AS n_keys
FROM raw_txn GROUP BY 1""", "raw_txn"))
def q_fingerprint(c):
    return Q.fingerprint(c.raw())


# A mirror that lost the lowest key and gained a copy of it under a new key:
# same row count, same distinct-key count, different content.
O.extra("mirror_off_by_two", ["raw_txn"], f"""
SELECT * FROM raw_txn WHERE {ID} <> (SELECT min({ID}) FROM raw_txn)
UNION ALL
SELECT * REPLACE ((SELECT max({ID}) + 1 FROM raw_txn) AS {ID}) FROM raw_txn
WHERE {ID} = (SELECT min({ID}) FROM raw_txn)""")


def mirror_off_by_two(raw):
    mm = raw.agg(F.min(ID).alias("__mn"), F.max(ID).alias("__mx"))  # one row
    x = raw.crossJoin(F.broadcast(mm))
    kept = x.filter(F.col(ID) != F.col("__mn")).drop("__mn", "__mx")
    moved = (x.filter(F.col(ID) == F.col("__mn")).withColumn(ID, F.col("__mx") + 1)
             .drop("__mn", "__mx"))
    return kept.unionByName(moved)


@register("fingerprint_diff", O.sql(f"""
WITH fa AS (SELECT substr(md5(CAST({ID} AS VARCHAR)), 1, 5) AS bucket, count(DISTINCT {ID}) AS na FROM raw_txn GROUP BY 1),
     fb AS (SELECT substr(md5(CAST({ID} AS VARCHAR)), 1, 5) AS bucket, count(DISTINCT {ID}) AS nb FROM mirror_off_by_two GROUP BY 1),
     d AS (SELECT coalesce(fa.bucket, fb.bucket) AS bucket FROM fa FULL OUTER JOIN fb ON fa.bucket = fb.bucket
           WHERE fa.na IS DISTINCT FROM fb.nb),
     ka AS (SELECT DISTINCT {ID}, substr(md5(CAST({ID} AS VARCHAR)), 1, 5) AS bucket FROM raw_txn),
     kb AS (SELECT DISTINCT {ID}, substr(md5(CAST({ID} AS VARCHAR)), 1, 5) AS bucket FROM mirror_off_by_two)
SELECT 'left_only' AS side, bucket, {ID} FROM ka WHERE bucket IN (SELECT bucket FROM d) AND {ID} NOT IN (SELECT {ID} FROM kb)
UNION ALL
SELECT 'right_only', bucket, {ID} FROM kb WHERE bucket IN (SELECT bucket FROM d) AND {ID} NOT IN (SELECT {ID} FROM ka)""",
                                    "raw_txn", "mirror_off_by_two"))
def q_fingerprint_diff(c):
    raw = c.raw()
    return Q.fingerprint_diff(raw, mirror_off_by_two(raw))


@register("ref_integrity", O.sql(" UNION ALL ".join(
    f"SELECT '{k}' AS fk, {_pct(f'count(*) FILTER (WHERE {k} = -1)')} AS unknown_pct, "
    f"count(*) FILTER (WHERE {k} IS NULL) AS null_fks FROM fact_transaction" for k in FKS), "fact_transaction"))
def q_ref_integrity(c):
    return Q.referential(c.table("fact_transaction"), FKS)


@register("orphans", O.sql(" UNION ALL ".join(
    f"SELECT '{k}' AS fk, count(*) AS orphan_rows, count(DISTINCT {k}) AS orphan_keys, CAST(min({k}) AS BIGINT) AS least_key FROM fact_transaction f "
    f"WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{dk} = f.{k})" for k, (d, dk) in FK_DIMS.items()),
    "fact_transaction", *[d for d, _ in FK_DIMS.values()]))
def q_orphans(c):
    return Q.orphans(c.table("fact_transaction"), c.dims(), FK_DIMS)


@register("dedup_recon", O.sql("""
SELECT s.scored_rows, d.deduped_rows, s.scored_rows - d.deduped_rows AS removed, d.distinct_ids, d.null_ids,
       t.ids_surviving_twice
FROM (SELECT count(*) AS scored_rows FROM scored) s,
     (SELECT count(*) AS deduped_rows, count(DISTINCT txn_id) AS distinct_ids,
             count(*) FILTER (WHERE txn_id IS NULL) AS null_ids FROM deduped) d,
     (SELECT count(*) AS ids_surviving_twice FROM (SELECT txn_id FROM deduped WHERE txn_id IS NOT NULL
      GROUP BY txn_id HAVING count(*) > 1)) t""", "scored", "deduped"))
def q_dedup_recon(c):
    return Q.dedup_recon(c.scored(), c.deduped())


@register("compare_firings", O.sql(" UNION ALL ".join(
    f"SELECT '{r.rule_id}' AS rule_id, (SELECT count(*) FROM fact_alert WHERE rule_id = '{r.rule_id}') AS firings, "
    f"count(*) AS baseline, (SELECT count(*) FROM fact_alert WHERE rule_id = '" + r.rule_id + f"') = count(*) AS matches FROM deduped WHERE {r.name} HAVING count(*) > 0"
    for r in R.RULES), "fact_alert", "deduped"))
def q_compare_firings(c):
    return Q.compare_firings(c.table("fact_alert"), Q.flag_baseline(c.deduped(), R.RULES))


@register("probe_value", O.sql(f"""
SELECT p.{ID}, CAST(s.txn_amount AS DOUBLE) AS silver_amount, CAST(f.txn_amount AS DOUBLE) AS fact_amount,
       s.txn_amount IS NOT DISTINCT FROM f.txn_amount AS same
FROM (SELECT min({ID}) AS {ID} FROM (SELECT txn_id, min({ID}) AS {ID} FROM silver WHERE txn_id IS NOT NULL
      GROUP BY txn_id HAVING count(*) = 1)) p
JOIN silver s ON s.{ID} = p.{ID} LEFT JOIN fact_transaction f ON f.{ID} = p.{ID}""", "silver", "fact_transaction"))
def q_probe_value(c):
    p = Q.probe_key(c.silver())
    s = c.silver().select(ID, F.col("txn_amount").alias("silver_amount"))
    f = c.table("fact_transaction").select(ID, F.col("txn_amount").alias("fact_amount"))
    return (p.join(s, ID).join(f, ID, "left")
            .withColumn("same", F.col("silver_amount").eqNullSafe(F.col("fact_amount"))))


# ------------------------------------------------------ rows-only checks (no SQL)
@register("schema_profile", None)
def q_schema_profile(c):
    return Q.check_schema(c.raw(), fixtures.RAW_COLUMNS, key=ID)


@register("locate_key", O.sql(f"SELECT 1 AS files, count(*) AS rows, max({ID}) AS key FROM raw_txn WHERE {ID} = (SELECT max({ID}) FROM raw_txn)", "raw_txn"))
def q_locate_key(c):
    """The greatest key is in one file, with its rows."""
    key = c.raw().agg(F.max(ID)).first()[0]
    found = Q.locate_key(c.raw(), ID, key)
    return found.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).withColumn("key", F.lit(key))


@register("table_stats", None)
def q_table_stats(c):
    return Q.table_stats(c.spark, c.folder("fact_transaction"))


@register("acceptance", None)
def q_acceptance(c):
    spark = c.spark
    ft, fa = c.table("fact_transaction"), c.table("fact_alert")

    def one(df, col):
        return df.collect()[0][col]
    checks = [
        ("C01", "scored - removed = deduped",
         lambda: one(Q.dedup_recon(c.scored(), c.deduped()).select(
             (F.col("scored_rows") - F.col("removed") == F.col("deduped_rows")).alias("ok")), "ok")),
        ("C02", "no id survives twice",
         lambda: one(Q.dedup_recon(c.scored(), c.deduped()), "ids_surviving_twice") == 0),
        ("C03", "every FK resolves",
         lambda: one(Q.orphans(ft, c.dims(), FK_DIMS).agg(F.sum("orphan_rows").alias("s")), "s") == 0),
        ("C04", "no NULL FKs", lambda: one(Q.referential(ft, FKS).agg(F.sum("null_fks").alias("s")), "s") == 0),
        ("C05", "firings equal flag recount",
         lambda: one(Q.compare_firings(fa, Q.flag_baseline(c.deduped(), R.RULES))
                     .agg(F.min(F.col("matches").cast("int")).alias("m")), "m") == 1),
        ("C06", "sum of firings = sum of rules_fired",
         lambda: one(fa.agg(F.count(F.lit(1)).alias("n")), "n") == one(ft.agg(F.sum("rules_fired").alias("s")), "s")),
        ("C07", "timestamps are instants",
         lambda: one(Q.check_instants(ft).agg(F.min(F.col("is_instant").cast("int")).alias("m")), "m") == 1),
    ]
    return Q.run_checks(spark, checks)


_GOLD = ["fact_transaction", "fact_alert", "dim_customer", "dim_merchant", "dim_channel", "dim_card",
         "dim_date", "dim_time", "dim_risk_rule"]


@register("compare_counts", O.sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows_a, count(*) AS rows_b, (SELECT count(*) FROM {t}) = count(*) AS equal FROM {t}"
    for t in _GOLD), *_GOLD))
def q_compare_counts(c):
    """Gold counts equal between the built layer and its exported copy."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources import sinks
    base = ensure_checkpoint_dir(c.spark).rstrip("/") + f"/vigil-export-{uuid.uuid4().hex[:12]}"
    gold = {t: c.table(t) for t in _GOLD}
    paths = sinks.export_gold(gold, base)
    exported = {t: c.spark.read.parquet(p) for t, p in paths.items()}
    return Q.compare_counts(gold, exported)
