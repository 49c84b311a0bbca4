"""Registered queries: checks that meet a planted defect, runs kept and compared, stored cubes, the star as one publication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cubes
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import rules as R
from ..session import scratch_path
from ..sources import sinks
from . import oracle as O
from .q_metrics import _eval, _round_doubles
from .q_quality import FK_DIMS, ID
from .registry import register

FT, FA = "fact_transaction", "fact_alert"
KEYS = {"fact_transaction": [ID], "fact_alert": [ID, "rule_id"], "dim_customer": ["customer_key"], "dim_merchant": ["merchant_key"], "dim_channel": ["channel_key"],
        "dim_card": ["card_key"], "dim_date": ["date_key"], "dim_time": ["time_key"], "dim_risk_rule": ["rule_id"]}
SUMS = {t: "weight" if t == "dim_risk_rule" else k[0] for t, k in KEYS.items()}

# --- keys without a row (H7, F7) ---

#: Every 97th row (a different rest for each key) points nowhere; the customer key of some is NULL.
_PLANT = {fk: i for i, fk in enumerate(FK_DIMS)}
O.extra("ft_orphans", ["fact_transaction"], "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {ID} % 97 = {i} THEN " + (f"CASE WHEN {ID} % 2 = 0 THEN NULL ELSE 900000000 + {ID} % 5 END" if fk == "customer_key" else f"900000000 + {ID} % 5") + f" ELSE {fk} END AS {fk}"
    for fk, i in _PLANT.items()) + ") FROM fact_transaction")


def _orphaned(fact):
    out = fact
    for fk, i in _PLANT.items():
        nowhere = F.lit(900_000_000) + F.col(ID) % 5
        if fk == "customer_key":
            nowhere = F.when(F.col(ID) % 2 != 0, nowhere)
        out = out.withColumn(fk, F.when(F.col(ID) % 97 == i, nowhere).otherwise(F.col(fk)))
    return out


@register("orphans_planted", O.sql(" UNION ALL ".join(
    f"SELECT '{k}' AS fk, count(*) AS orphan_rows, count(DISTINCT coalesce({k}, -999)) AS orphan_keys, CAST(min({k}) AS BIGINT) AS least_key FROM ft_orphans f "
    f"WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{dk} = f.{k})" for k, (d, dk) in FK_DIMS.items()), "ft_orphans", *[d for d, _ in FK_DIMS.values()]))
def q_orphans_planted(c):
    return Q.orphans(_orphaned(c.table(FT)), c.dims(), FK_DIMS)


# --- surviving duplicates (H8) ---

O.extra("deduped_twice", ["deduped"], f"SELECT txn_id, {ID} FROM deduped UNION ALL SELECT txn_id, -{ID} FROM deduped WHERE {ID} % 41 = 3")


def _twice(c):
    d = c.deduped().select("txn_id", ID)
    return d.unionByName(d.filter(F.col(ID) % 41 == 3).withColumn(ID, -F.col(ID)))


@register("dedup_recon_planted", O.sql("""
SELECT s.n AS scored_rows, d.n AS deduped_rows, s.n - d.n AS removed, d.ids AS distinct_ids, d.nulls AS null_ids, t.n AS ids_surviving_twice
FROM (SELECT count(*) AS n FROM scored) s, (SELECT count(*) AS n, count(DISTINCT txn_id) AS ids, count(*) - count(txn_id) AS nulls FROM deduped_twice) d,
     (SELECT count(*) AS n FROM (SELECT txn_id FROM deduped_twice GROUP BY txn_id HAVING count(txn_id) > 1)) t""", "scored", "deduped_twice"))
def q_dedup_recon_planted(c):
    return Q.dedup_recon(c.scored(), _twice(c))


@register("dedup_survivors", O.sql("SELECT txn_id, count(*) AS rows FROM deduped_twice GROUP BY txn_id HAVING count(txn_id) > 1 ORDER BY txn_id LIMIT 5", "deduped_twice"))
def q_dedup_survivors(c):
    return Q.survivors(_twice(c))


# --- runs (H10) ---

_FIRED = " UNION ALL ".join(f"SELECT '{r.rule_id}' AS metric, count(*) AS value FROM deduped WHERE {r.name}" for r in R.RULES)


@register("run_ledger", O.sql(f"""
WITH usual AS ({_FIRED}), changed AS (SELECT metric, CASE WHEN metric = 'R07' THEN (SELECT count(*) FROM deduped WHERE merchant_mcc IN ('6011', '4829')) ELSE value END AS value FROM usual),
runs AS (SELECT 1 AS run, * FROM usual UNION ALL SELECT 2, * FROM usual UNION ALL SELECT 3, * FROM changed UNION ALL SELECT 4, * FROM changed WHERE metric <> 'R09' UNION ALL SELECT 4, 'R09', 0)
SELECT a.run, a.metric, a.value, b.value AS previous, a.value <> b.value AS moved FROM runs a JOIN runs b ON a.metric = b.metric AND a.run = b.run + 1""", "deduped"))
def q_run_ledger(c):
    """Firings of four runs: the flags, the alert table, a run with a narrower rule R07, and one without R09."""
    path = scratch_path(c.spark, "runs")
    d, a = c.deduped(), c.table(FA)
    zero = c.spark.createDataFrame([(r.rule_id, 0) for r in R.RULES], "metric string, value long")

    def firings(rows):
        return rows.groupBy(F.col("rule_id").alias("metric")).agg(F.count(F.lit(1)).alias("value")).unionByName(zero).groupBy("metric").agg(F.sum("value").alias("value"))

    narrow = a.join(d.select(ID, "merchant_mcc"), ID).filter((F.col("rule_id") != "R07") | F.col("merchant_mcc").isin("6011", "4829"))
    flags = Q.flag_baseline(d, R.RULES).select(F.col("rule_id").alias("metric"), F.col("firings").alias("value"))
    Q.record_run(flags.unionByName(zero).groupBy("metric").agg(F.sum("value").alias("value")), path, 1)
    Q.record_run(firings(a), path, 2)
    Q.record_run(firings(narrow), path, 3)
    Q.record_run(firings(narrow).filter("metric <> 'R09'"), path, 4)
    return Q.compare_runs(c.spark, path)


# --- what a typed load would take (H6) ---

_PARSE = {"posting_date": "DATE", "txn_amount": "DECIMAL(18,2)", "amount_local": "DECIMAL(18,2)", "txn_datetime": "TIMESTAMP"}


@register("parse_rates", O.sql(" UNION ALL ".join(
    f"SELECT '{col}' AS column_name, 100.0 * CAST(count(TRY_CAST({col} AS {kind})) AS DOUBLE) / greatest(count({col}), 1) AS pct_parse FROM raw_txn" for col, kind in _PARSE.items()), "raw_txn"))
def q_parse_rates(c):
    return Q.parse_rates(c.raw())


@register("parse_samples", O.sql(" UNION ALL ".join(
    f"(SELECT '{col}' AS column_name, {col} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {col}) AS place FROM raw_txn "
    f"WHERE {col} IS NOT NULL AND TRY_CAST({col} AS {kind}) IS NULL GROUP BY {col} QUALIFY place <= 3)" for col, kind in _PARSE.items()), "raw_txn"))
def q_parse_samples(c):
    return Q.parse_samples(c.raw())


# --- an export that lost rows (H17) ---

@register("compare_counts_planted", O.sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_a, count(*) FILTER (WHERE {SUMS[t]} % 13 <> 1) AS rows_b, count(*) = count(*) FILTER (WHERE {SUMS[t]} % 13 <> 1) AS equal FROM {t}"
    for t in KEYS), *KEYS))
def q_compare_counts_planted(c):
    gold = {t: c.table(t) for t in KEYS}
    return Q.compare_counts(gold, {t: df.filter(F.col(SUMS[t]) % 13 != 1) for t, df in gold.items()})


# --- the star as one publication (A10) ---

_SEEN = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, CAST(sum({SUMS[t]}) AS BIGINT) AS keys FROM {t}" for t in KEYS)


@register("star_published", O.sql(f"""
WITH seen AS ({_SEEN}) SELECT moment, table_name, rows, CASE WHEN moment = 'third' AND table_name = 'fact_alert' THEN CAST(2 * keys AS BIGINT) ELSE keys END AS keys
FROM seen, (VALUES ('first'), ('failed'), ('third')) AS m(moment)""", *KEYS))
def q_star_published(c):
    """A10: nine tables are armed together. The second publication fails at its last table: readers stay on the first version;
    the third changes the alert table's keys."""
    spark, path, out = c.spark, scratch_path(c.spark, "star"), None
    gold = {t: c.table(t) for t in KEYS}

    def look(moment):
        part = None
        for t, df in sinks.read_set(spark, path).items():
            one = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(SUMS[t]).cast("long").alias("keys")).select(F.lit(moment).alias("moment"), F.lit(t).alias("table_name"), "rows", "keys")
            part = one if part is None else part.unionByName(one)
        return c.materialize(part, "seen")

    doubled = gold["fact_alert"].withColumn(ID, F.col(ID) * 2)
    sinks.publish_set(gold, path, KEYS)
    out = look("first")
    broken = gold["dim_risk_rule"].withColumn("weight", F.when(F.col("weight") >= 0, F.raise_error(F.lit("lost")).cast("int")))
    try:
        sinks.publish_set(gold | {"fact_alert": doubled, "dim_risk_rule": broken}, path, KEYS)
        raise RuntimeError("a broken publication was armed")
    except Exception as e:
        if "lost" not in str(e):
            raise
    out = out.unionByName(look("failed"))
    sinks.publish_set(gold | {"fact_alert": doubled}, path, KEYS)
    return out.unionByName(look("third"))


# --- stored cubes (J19-J22, J27) and money as whole sen ---

CUBES = {
    "overview": ["dim_date.yr", "dim_date.mth", "dim_channel.channel", "fact_transaction.risk_band", "fact_transaction.txn_type"],
    "rules": ["fact_transaction.rules_fired", "fact_transaction.risk_band"],
    "mcc": ["dim_merchant.merchant_mcc", "fact_transaction.risk_band"],
    "currency": ["fact_transaction.txn_currency", "fact_transaction.risk_band"],
    "brand": ["dim_card.card_brand", "fact_transaction.risk_band"],
    "entry": ["dim_channel.entry_mode", "fact_transaction.risk_band"],
}
STORED = ["transactions", "total_amount", "avg_risk_score"]
_ATTRS = list(dict.fromkeys(a for by in CUBES.values() for a in by))
_INT = ("yr", "mth", "rules_fired")


def _attr_sql(a, by):
    n = M._alias(a)
    if a not in by:
        return f"CAST(NULL AS {'BIGINT' if n in _INT else 'VARCHAR'}) AS {n}"
    return f"CAST({n} AS BIGINT) AS {n}" if n in _INT else n


@register("cubes_one_scan", O.sql(" UNION ALL ".join(
    f"SELECT '{name}' AS cube, {', '.join(_attr_sql(a, by) for a in _ATTRS)}, count(*) AS transactions, CAST(sum(txn_amount) AS DOUBLE) AS total_amount, CAST(sum(risk_score) AS BIGINT) AS score FROM ft_x GROUP BY {', '.join(M._alias(a) for a in by)}"
    for name, by in CUBES.items()), "ft_x"))
def q_cubes_one_scan(c):
    """J19 to J22 from one scan of the fact."""
    return cubes.build(c.star(), CUBES, STORED).select("cube", *[M._alias(a) for a in _ATTRS], "transactions", "total_amount", F.col("avg_risk_score__sum").cast("long").alias("score"))


def _stored(c):
    return c._get("cube_overview", lambda: cubes.build(c.star(), {"overview": CUBES["overview"]}, STORED))


def _roll(key, by, measures):
    names = [M._alias(a) for a in by]
    sql = {"transactions": "count(*) AS transactions", "total_amount": "CAST(sum(txn_amount) AS DOUBLE) AS total_amount", "avg_risk_score": "round(avg(risk_score), 6) AS avg_risk_score"}
    register(key, O.sql(f"SELECT {', '.join(_attr_sql(a, by) for a in by)}, {', '.join(sql[m] for m in measures)} FROM ft_x GROUP BY {', '.join(names)}", "ft_x"))(
        lambda c: _round_doubles(cubes.roll_up(_stored(c), by, measures)))


_roll("rollup_month_band", ["dim_date.yr", "dim_date.mth", "fact_transaction.risk_band"], STORED)
_roll("rollup_channel_band", ["dim_channel.channel", "fact_transaction.risk_band"], STORED)
_roll("rollup_band_type", ["fact_transaction.risk_band", "fact_transaction.txn_type"], STORED)


@register("kpi_headline_sen", O.sql("""
SELECT count(*) AS transactions, count(*) FILTER (WHERE risk_band = 'HIGH') AS alerts_raised, CAST(sum(txn_amount) * 100 AS BIGINT) AS total_amount,
       CAST(sum(txn_amount) FILTER (WHERE risk_band = 'HIGH') * 100 AS BIGINT) AS exposure_at_risk, CAST(sum(txn_amount) FILTER (WHERE txn_currency IS DISTINCT FROM 'MYR') * 100 AS BIGINT) AS cross_border_amount
FROM fact_transaction""", "fact_transaction"))
def q_kpi_headline_sen(c):
    """Money as whole sen."""
    return M.evaluate(c.star(), ["transactions", "alerts_raised", "total_amount", "exposure_at_risk", "cross_border_amount"], cents=True)


@register("band_replaced", O.sql("""
SELECT channel, risk_band, count(*) AS transactions, nullif(sum(count(*) FILTER (WHERE risk_band = 'HIGH')) OVER (PARTITION BY channel), 0)::BIGINT AS high_risk_txns,
       CAST(sum(sum(txn_amount) FILTER (WHERE risk_band = 'HIGH')) OVER (PARTITION BY channel) AS DOUBLE) AS exposure_at_risk
FROM ft_x GROUP BY channel, risk_band""", "ft_x"))
def q_band_replaced(c):
    """A measure's own filter on the band replaces the band it is grouped by: each band shows its channel's high-risk rows."""
    return _eval(c, ["transactions", "high_risk_txns", "exposure_at_risk"], by=["dim_channel.channel", "fact_transaction.risk_band"])
