"""Registered queries: rule and score analyses (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import analysis as A
from ..operators import rules as R
from . import oracle as O
from .registry import register

_RULES = R.RULES


def _rule_union(select_tpl: str) -> str:
    return " UNION ALL ".join(select_tpl.format(rid=r.rule_id, name=r.name, w=r.weight) for r in _RULES)


def _pct(num, den):
    return f"(100.0 * CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE))"


FIRE_RATES_SQL = O.sql(f"""
SELECT rule_id, rule_name, CAST(weight AS BIGINT) AS weight, firings, fire_pct,
  CASE WHEN fire_pct > {A.TOO_COMMON_PCT} THEN 'too common' WHEN fire_pct < {A.TOO_RARE_PCT} THEN 'too rare'
       ELSE 'usable' END AS verdict
FROM (SELECT *, {_pct('firings', 'rows')} AS fire_pct FROM (
  {_rule_union("SELECT '{rid}' AS rule_id, '{name}' AS rule_name, {w} AS weight, "
               "count(*) FILTER (WHERE {name}) AS firings, count(*) AS rows FROM scored")}))""", "scored")


@register("fire_rates", FIRE_RATES_SQL)
def q_fire_rates(c):
    return A.fire_rates(c.scored())


@register("rule_effectiveness", O.sql(f"""
SELECT a.rule_id, r.rule_name, count(*) AS firings,
       {_pct('count(*)', '(SELECT count(*) FROM fact_transaction)')} AS pct_of_txns
FROM fact_alert a JOIN dim_risk_rule r USING (rule_id) GROUP BY 1, 2""",
                                      "fact_alert", "dim_risk_rule", "fact_transaction"))
def q_rule_effectiveness(c):
    return A.rule_effectiveness(c.table("fact_alert"), c.table("dim_risk_rule"), c.table("fact_transaction"))


_BAND_CASE = ("CASE WHEN risk_score < 20 THEN '0-19' WHEN risk_score < 40 THEN '20-39' "
              "WHEN risk_score < 60 THEN '40-59' WHEN risk_score < 80 THEN '60-79' ELSE '80+' END")


@register("score_bands", O.sql(f"""
SELECT score_band, n, {_pct('n', 'sum(n) OVER ()')} AS pct FROM (
  SELECT {_BAND_CASE} AS score_band, count(*) AS n FROM scored GROUP BY 1)""", "scored"))
def q_score_bands(c):
    return A.score_bands(c.scored())


@register("score_summary", O.sql("""
SELECT CAST(min(risk_score) AS BIGINT) AS min_score, round(avg(risk_score), 6) AS mean_score,
       CAST(max(risk_score) AS BIGINT) AS max_score, round(stddev_samp(risk_score), 6) AS stddev_score
FROM scored""", "scored"))
def q_score_summary(c):
    return A.score_summary(c.scored())


_LIFT_SQL = O.sql(f"""
SELECT rule_id, rule_name, round(top_pct, 6) AS top_pct, round(bottom_pct, 6) AS bottom_pct,
       round(q90, 6) AS q90, round(q10, 6) AS q10 FROM (
  {_rule_union("SELECT '{rid}' AS rule_id, '{name}' AS rule_name, "
               "100.0 * CAST(count(*) FILTER (WHERE {name} AND risk_score >= q90) AS DOUBLE) "
               "/ CAST(count(*) FILTER (WHERE risk_score >= q90) AS DOUBLE) AS top_pct, "
               "100.0 * CAST(count(*) FILTER (WHERE {name} AND risk_score <= q10) AS DOUBLE) "
               "/ CAST(count(*) FILTER (WHERE risk_score <= q10) AS DOUBLE) AS bottom_pct, "
               "max(q90) AS q90, max(q10) AS q10 "
               "FROM scored, (SELECT quantile_cont(risk_score, 0.9) AS q90, "
               "quantile_cont(risk_score, 0.1) AS q10 FROM scored)")})""", "scored")


@register("decile_lift", _LIFT_SQL)
def q_decile_lift(c):
    return A.decile_lift(c.scored())


@register("discrimination", O.sql(f"""
SELECT measure, groups, round(sd, 6) AS sd_of_means, round(mean, 6) AS mean_of_means,
       round(100.0 * sd / mean, 6) AS cv_pct FROM (
  SELECT 'risk_score' AS measure, count(*) AS groups, stddev_samp(m) AS sd, avg(m) AS mean FROM (
    SELECT avg(risk_score) AS m FROM scored WHERE entry_mode IS NOT NULL AND trim(entry_mode) <> ''
    GROUP BY entry_mode HAVING count(*) > {A.DISCRIMINATION_MIN_GROUP})
  UNION ALL
  SELECT 'fraud_score', count(*), stddev_samp(m), avg(m) FROM (
    SELECT avg({O.o_scrape('fraud_score')}) AS m FROM raw_txn
    WHERE upper(trim(entry_mode)) IS NOT NULL AND trim(upper(trim(entry_mode))) <> ''
    GROUP BY upper(trim(entry_mode)) HAVING count(*) > {A.DISCRIMINATION_MIN_GROUP}))""",
                                  "scored", "raw_txn"))
def q_discrimination(c):
    sc = c.scored()
    raw = c.raw()
    src = raw.select(F.upper(F.trim("entry_mode")).alias("entry_mode"),
                     clean.scrape_number("fraud_score").alias("fs"))
    return (A.discrimination(sc, "entry_mode", "risk_score", "risk_score")
            .unionByName(A.discrimination(src, "entry_mode", "fs", "fraud_score")))


@register("band_mix", O.sql(f"""
SELECT risk_band, n, {_pct('n', 'sum(n) OVER ()')} AS pct
FROM (SELECT risk_band, count(*) AS n FROM fact_transaction GROUP BY 1)""", "fact_transaction"))
def q_band_mix(c):
    return A.band_mix(c.table("fact_transaction"))


@register("score_hist", O.sql(f"""
SELECT CAST(floor(risk_score / {A.HIST_WIDTH}) * {A.HIST_WIDTH} AS BIGINT) AS score_bucket, count(*) AS n,
       floor(risk_score / {A.HIST_WIDTH}) * {A.HIST_WIDTH} >= {A.ALERT_THRESHOLD} AS at_or_above_threshold
FROM fact_transaction GROUP BY 1, 3""", "fact_transaction"))
def q_score_hist(c):
    return A.histogram5(c.table("fact_transaction"))


@register("cofiring", O.sql("""
SELECT CAST(rules_fired AS BIGINT) AS rules_fired, risk_band, count(*) AS n
FROM fact_transaction GROUP BY 1, 2""", "fact_transaction"))
def q_cofiring(c):
    return A.cofiring(c.table("fact_transaction"))


# The outcome that the table itself gives: the issuer declined. Rule R09 reads it too, so its weight is left out of the score.
O.extra("labelled", ["fact_transaction"], "SELECT risk_score - CASE WHEN auth_approved = FALSE THEN 10 ELSE 0 END AS risk_score, coalesce(NOT auth_approved, FALSE) AS is_fraud FROM fact_transaction")


_THR = ", ".join(f"({t})" for t in A.THRESHOLDS)


@register("threshold_tradeoff", O.sql(f"""
SELECT CAST(thr AS BIGINT) AS thr, alerts, round(100.0 * CAST(alerts AS DOUBLE) / CAST(total AS DOUBLE), 6) AS alert_pct,
  tp, fn, round(prec * 100.0, 6) AS precision_pct, round(rec * 100.0, 6) AS recall_pct,
  round((1.0 - prec) * 100.0, 6) AS fp_rate_pct, round(ay, 6) AS analyst_years,
  round(ay / {A.DATA_SPAN_YEARS}, 6) AS fte FROM (
  SELECT *, CASE WHEN alerts > 0 THEN CAST(tp AS DOUBLE) / CAST(alerts AS DOUBLE) ELSE 0.0 END AS prec,
         CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS rec,
         CAST(alerts AS DOUBLE) / {float(A.ANALYST_ALERTS_PER_YEAR)} AS ay FROM (
    SELECT t.thr, count(*) AS total,
           count(*) FILTER (WHERE risk_score >= t.thr) AS alerts,
           count(*) FILTER (WHERE risk_score >= t.thr AND is_fraud) AS tp,
           count(*) FILTER (WHERE risk_score < t.thr AND is_fraud) AS fn
    FROM labelled, (VALUES {_THR}) AS t(thr) GROUP BY t.thr))""", "labelled"))
def q_threshold_tradeoff(c):
    weight = next(r.weight for r in R.RULES if r.name == "declined")
    facts = c.table("fact_transaction").withColumn("declined", F.coalesce(~F.col("auth_approved"), F.lit(False)))
    return A.threshold_tradeoff(facts.withColumn("risk_score", F.col("risk_score") - F.when(F.col("declined"), weight).otherwise(0)), "declined")
