"""Registered queries: measures (J1-J17), report cubes (J18-J27), extensions X6-X8."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import metrics as M
from . import oracle as O
from .registry import register

FT, FA = "fact_transaction", "fact_alert"
STAR = ["fact_transaction", "fact_alert", "dim_date", "dim_time", "dim_customer", "dim_merchant",
        "dim_channel", "dim_card", "dim_risk_rule"]


def _round_doubles(df):
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _eval(c, measures, by=(), where=None):
    return _round_doubles(M.evaluate(c.star(), measures, by, where))


# ------------------------------------------------------------- oracle frames
O.extra("ft_x", ["fact_transaction", "dim_date", "dim_time", "dim_merchant", "dim_channel", "dim_card"], """
SELECT f.*, d.yr, d.mth, t.is_odd_hour, m.merchant_mcc, c.channel, c.entry_mode, c.is_card_not_present,
       k.card_brand
FROM fact_transaction f
LEFT JOIN dim_date d ON f.date_key = d.date_key LEFT JOIN dim_time t ON f.time_key = t.time_key
LEFT JOIN dim_merchant m ON f.merchant_key = m.merchant_key
LEFT JOIN dim_channel c ON f.channel_key = c.channel_key LEFT JOIN dim_card k ON f.card_key = k.card_key""")
O.extra("fa_x", ["fact_alert", "fact_transaction", "dim_channel"], """
SELECT a.*, c.channel FROM fact_alert a
LEFT JOIN fact_transaction f ON a._mirror_row_id = f._mirror_row_id
LEFT JOIN dim_channel c ON f.channel_key = c.channel_key""")

# SQL for each base measure: (frame, aggregate, filter)
_BASE_SQL = {
    "transactions": ("ft_x", "count(*)", None),
    "total_amount": ("ft_x", "CAST(sum(txn_amount) AS DOUBLE)", None),
    "distinct_customers": ("ft_x", "count(DISTINCT customer_key)", None),
    "avg_risk_score": ("ft_x", "avg(risk_score)", None),
    "high_risk_txns": ("ft_x", "count(*)", "risk_band = 'HIGH'"),
    "exposure_at_risk": ("ft_x", "CAST(sum(txn_amount) AS DOUBLE)", "risk_band = 'HIGH'"),
    "approved_txns": ("ft_x", "count(*)", "auth_approved = TRUE"),
    "decided_txns": ("ft_x", "count(*)", "auth_approved IS NOT NULL"),
    "cross_border_amount": ("ft_x", "CAST(sum(txn_amount) AS DOUBLE)",
                            f"txn_currency IS DISTINCT FROM '{M.HOME_CURRENCY}'"),
    "alerts_raised": ("ft_x", "count(*)", "risk_band = 'HIGH'"),
    "rule_firings": ("fa_x", "count(*)", None),
    "txns_with_any_rule": ("fa_x", "count(DISTINCT _mirror_row_id)", None),
}
_DERIVED_SQL = {
    "high_risk_rate": ("high_risk_txns", "transactions"),
    "approval_rate": ("approved_txns", "decided_txns"),
    "alert_rate": ("alerts_raised", "transactions"),
    "firings_per_txn": ("rule_firings", "transactions"),
    "any_rule_rate": ("txns_with_any_rule", "transactions"),
    "firings_per_alert": ("rule_firings", "alerts_raised"),
}


def _base_sql(k, group):
    frame, agg, flt = _BASE_SQL[k]
    where = f" WHERE {flt}" if flt else ""
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"SELECT {g}{agg} AS {k} FROM {frame}{where}{gb}"


def _measure_by_sql(k, group, group_frame_ok=lambda b: True):
    """Oracle for one measure grouped by one column available in both frames."""
    if k in _BASE_SQL:
        v = f"round({k}, 6)" if k == "avg_risk_score" else k
        return O.sql(f"SELECT {group}, {v} AS {k} FROM ({_base_sql(k, group)})", "ft_x", "fa_x")
    if k == "analyst_years":
        return O.sql(f"SELECT {group}, round(CAST(alerts_raised AS DOUBLE) / {float(M.ANALYST_ALERTS_PER_YEAR)}, 6)"
                     f" AS {k} FROM ({_base_sql('alerts_raised', group)})", "ft_x", "fa_x")
    a, b = _DERIVED_SQL[k]
    return O.sql(f"""
SELECT g.{group}, round(CAST(x.{a} AS DOUBLE) / CAST(y.{b} AS DOUBLE), 6) AS {k} FROM
  (SELECT {group} FROM ({_base_sql(a, group)}) UNION SELECT {group} FROM ({_base_sql(b, group)})) g
  LEFT JOIN ({_base_sql(a, group)}) x ON x.{group} IS NOT DISTINCT FROM g.{group}
  LEFT JOIN ({_base_sql(b, group)}) y ON y.{group} IS NOT DISTINCT FROM g.{group}
WHERE x.{a} IS NOT NULL AND y.{b} IS NOT NULL AND y.{b} <> 0""", "ft_x", "fa_x")


for _k in M.PUBLISHED:
    register(f"m_{_k}", _measure_by_sql(_k, "channel"))(
        lambda c, _k=_k: _eval(c, [_k], by=["dim_channel.channel"]))


# fact_alert measures by rule: the transaction measures are not split by rule.
def _by_rule_sql(k):
    tot = {"transactions": "(SELECT count(*) FROM fact_transaction)",
           "alerts_raised": "(SELECT count(*) FROM fact_transaction WHERE risk_band = 'HIGH')"}
    if k in ("rule_firings", "txns_with_any_rule"):
        agg = "count(*)" if k == "rule_firings" else "count(DISTINCT _mirror_row_id)"
        return O.sql(f"SELECT rule_id, {agg} AS {k} FROM fact_alert GROUP BY rule_id", "fact_alert")
    num, den = _DERIVED_SQL[k]
    agg = "count(*)" if num == "rule_firings" else "count(DISTINCT _mirror_row_id)"
    return O.sql(f"SELECT rule_id, round(CAST({agg} AS DOUBLE) / CAST({tot[den]} AS DOUBLE), 6) AS {k} "
                 "FROM fact_alert GROUP BY rule_id", "fact_alert", "fact_transaction")


for _k in ("rule_firings", "firings_per_txn", "txns_with_any_rule", "any_rule_rate", "firings_per_alert"):
    register(f"m_{_k}_by_rule", _by_rule_sql(_k))(
        lambda c, _k=_k: _eval(c, [_k], by=["dim_risk_rule.rule_id"]))


# Replace-filter semantics: grouped by band, High Risk Transactions is the
# HIGH count on every band row.
@register("m_high_risk_by_band", O.sql("""
SELECT risk_band, count(*) AS transactions,
       (SELECT count(*) FROM fact_transaction WHERE risk_band = 'HIGH') AS high_risk_txns
FROM fact_transaction GROUP BY risk_band""", "fact_transaction"))
def q_m_high_risk_by_band(c):
    return _eval(c, ["transactions", "high_risk_txns"], by=["fact_transaction.risk_band"])


# ------------------------------------------------------------------- cubes (J)
@register("kpi_headline", O.sql("""
SELECT (SELECT count(*) FROM fact_transaction) AS transactions,
       (SELECT count(*) FROM fact_transaction WHERE risk_band = 'HIGH') AS alerts_raised,
       (SELECT CAST(sum(txn_amount) AS DOUBLE) FROM fact_transaction) AS total_amount,
       round((SELECT CAST(count(*) FILTER (WHERE auth_approved) AS DOUBLE)
                     / CAST(count(auth_approved) AS DOUBLE) FROM fact_transaction), 6) AS approval_rate""",
                                "fact_transaction"))
def q_kpi_headline(c):
    return _eval(c, ["transactions", "alerts_raised", "total_amount", "approval_rate"])


def _cube(key, by_attrs, measures):
    cols = [a.split(".")[1] for a in by_attrs]
    g = ", ".join(cols)
    ms = {"transactions": "count(*) AS transactions",
          "total_amount": "CAST(sum(txn_amount) AS DOUBLE) AS total_amount"}
    sel = ", ".join(("CAST(rules_fired AS BIGINT) AS rules_fired" if x == "rules_fired"
                     else "CAST(yr AS BIGINT) AS yr" if x == "yr" else "CAST(mth AS BIGINT) AS mth" if x == "mth"
                     else x) for x in cols)
    sql = O.sql(f"SELECT {sel}, {', '.join(ms[m] for m in measures)} FROM ft_x GROUP BY {g}", "ft_x")
    register(key, sql)(lambda c: _eval(c, measures, by=by_attrs))


_cube("cube_overview", ["dim_date.yr", "dim_date.mth", "dim_channel.channel", "fact_transaction.risk_band",
                        "fact_transaction.txn_type"], ["transactions", "total_amount"])
_cube("cube_rules_band", ["fact_transaction.rules_fired", "fact_transaction.risk_band"], ["transactions"])
_cube("cube_mcc", ["dim_merchant.merchant_mcc", "fact_transaction.risk_band"], ["transactions", "total_amount"])
_cube("cube_currency", ["fact_transaction.txn_currency", "fact_transaction.risk_band"],
      ["transactions", "total_amount"])
_cube("cube_brand", ["dim_card.card_brand", "fact_transaction.risk_band"], ["transactions", "total_amount"])
_cube("cube_entry", ["dim_channel.entry_mode", "fact_transaction.risk_band"], ["transactions", "total_amount"])
_cube("trend_month_band", ["dim_date.yr", "dim_date.mth", "fact_transaction.risk_band"], ["transactions"])
_cube("channel_band", ["dim_channel.channel", "fact_transaction.risk_band"], ["transactions"])
_cube("band_type_mix", ["fact_transaction.risk_band", "fact_transaction.txn_type"], ["transactions"])


@register("risk_kpis", O.sql("""
SELECT round(100.0 * CAST(count(*) FILTER (WHERE is_card_not_present) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS cnp_pct,
       round(100.0 * CAST(sum(txn_amount) FILTER (WHERE txn_currency IS DISTINCT FROM 'MYR') AS DOUBLE)
             / CAST(sum(txn_amount) AS DOUBLE), 6) AS foreign_value_pct,
       round(100.0 * CAST(count(*) FILTER (WHERE is_odd_hour) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS odd_hour_pct,
       round(100.0 * CAST(count(*) FILTER (WHERE auth_approved = FALSE) AS DOUBLE)
             / CAST(count(auth_approved) AS DOUBLE), 6) AS declined_pct,
       round(avg(risk_score), 6) AS mean_score
FROM ft_x""", "ft_x"))
def q_risk_kpis(c):
    f = c.table(FT)
    ch = c.table("dim_channel").select("channel_key", "is_card_not_present")  # entry mode is free text: AQE decides
    tm = F.broadcast(c.table("dim_time").select("time_key", "is_odd_hour"))  # 25 rows
    x = f.join(ch, "channel_key", "left").join(tm, "time_key", "left")
    p = lambda a, b: F.round(F.lit(100.0) * a.cast("double") / b.cast("double"), 6)
    return x.agg(
        p(F.count_if("is_card_not_present"), F.count(F.lit(1))).alias("cnp_pct"),
        p(F.sum(F.when(~F.col("txn_currency").eqNullSafe(F.lit(M.HOME_CURRENCY)), F.col("txn_amount"))),
          F.sum("txn_amount")).alias("foreign_value_pct"),
        p(F.count_if("is_odd_hour"), F.count(F.lit(1))).alias("odd_hour_pct"),
        p(F.count_if(F.col("auth_approved") == F.lit(False)), F.count("auth_approved")).alias("declined_pct"),
        F.round(F.avg("risk_score"), 6).alias("mean_score"))


@register("scope_line", O.sql("""
SELECT (SELECT count(*) FROM fact_transaction) AS in_scope, (SELECT count(*) FROM scored) AS total_rows,
       round(100.0 * CAST((SELECT count(*) FROM fact_transaction) AS DOUBLE)
             / CAST((SELECT count(*) FROM scored) AS DOUBLE), 6) AS in_scope_pct""", "fact_transaction", "scored"))
def q_scope_line(c):
    a = c.table(FT).agg(F.count(F.lit(1)).alias("in_scope"))
    b = c.scored().agg(F.count(F.lit(1)).alias("total_rows"))
    return a.crossJoin(b).withColumn(
        "in_scope_pct", F.round(F.lit(100.0) * F.col("in_scope").cast("double") / F.col("total_rows").cast("double"), 6))


# Currency codes treated as resolvable.
ISO_CURRENCIES = ("MYR", "USD", "SGD", "EUR", "GBP", "AUD", "JPY")
_ISO = ", ".join(f"'{x}'" for x in ISO_CURRENCIES)


@register("unresolvable_currency", O.sql(f"""
SELECT count(*) AS txns, CAST(sum(txn_amount) AS DOUBLE) AS amount
FROM fact_transaction WHERE txn_currency IS NULL OR txn_currency NOT IN ({_ISO})""", "fact_transaction"))
def q_unresolvable_currency(c):
    f = c.table(FT).filter(F.col("txn_currency").isNull() | ~F.col("txn_currency").isin(*ISO_CURRENCIES))
    return f.agg(F.count(F.lit(1)).alias("txns"), F.sum("txn_amount").alias("amount"))


# ---------------------------------------------------------------- extensions
TRIAGE_TOP = 50


@register("triage_queue", O.sql(f"""
SELECT t._mirror_row_id, t.txn_id, CAST(t.risk_score AS BIGINT) AS risk_score,
       string_agg(a.rule_id, ',' ORDER BY a.rule_id) AS rules
FROM (SELECT * FROM fact_transaction WHERE risk_band = 'HIGH'
      ORDER BY risk_score DESC, _mirror_row_id LIMIT {TRIAGE_TOP}) t
JOIN fact_alert a ON a._mirror_row_id = t._mirror_row_id
GROUP BY 1, 2, 3""", "fact_transaction", "fact_alert"))
def q_triage_queue(c):
    """The top HIGH transactions by score with their named rules. The
    top-k is the feature; the k rows are broadcast (size = k)."""
    top = (c.table(FT).filter(F.col("risk_band") == "HIGH")
           .orderBy(F.col("risk_score").desc(), F.col("_mirror_row_id").asc()).limit(TRIAGE_TOP)
           .select("_mirror_row_id", "txn_id", "risk_score"))
    a = c.table(FA).join(F.broadcast(top.select("_mirror_row_id")), "_mirror_row_id", "left_semi")
    rules = a.groupBy("_mirror_row_id").agg(F.array_join(F.array_sort(F.collect_list("rule_id")), ",").alias("rules"))
    return top.join(rules, "_mirror_row_id")


@register("customer_risk", O.sql("""
SELECT CAST(risk_rank AS BIGINT) AS risk_rank, CAST(kyc_rank AS BIGINT) AS kyc_rank, count(*) AS customers,
       count(*) FILTER (WHERE ever_pep) AS pep, count(*) FILTER (WHERE ever_sanctioned) AS sanctioned
FROM dim_customer WHERE customer_key <> -1 GROUP BY 1, 2""", "dim_customer"))
def q_customer_risk(c):
    d = c.table("dim_customer").filter(F.col("customer_key") != -1)
    return d.groupBy("risk_rank", "kyc_rank").agg(F.count(F.lit(1)).alias("customers"),
                                                  F.count_if("ever_pep").alias("pep"),
                                                  F.count_if("ever_sanctioned").alias("sanctioned"))


CONCENTRATION_TOP = 10


@register("merchant_concentration", O.sql(f"""
SELECT merchant_id, CAST(amount AS DOUBLE) AS amount,
       round(100.0 * CAST(amount AS DOUBLE) / CAST(total AS DOUBLE), 6) AS share_pct FROM (
  SELECT m.merchant_id, sum(f.txn_amount) AS amount,
         (SELECT sum(txn_amount) FROM fact_transaction) AS total
  FROM fact_transaction f JOIN dim_merchant m ON f.merchant_key = m.merchant_key
  GROUP BY m.merchant_id HAVING sum(f.txn_amount) IS NOT NULL
  ORDER BY amount DESC, merchant_id LIMIT {CONCENTRATION_TOP})""", "fact_transaction", "dim_merchant"))
def q_merchant_concentration(c):
    """Top merchants by share of exposure (a top-k report)."""
    f = c.table(FT)
    total = f.agg(F.sum("txn_amount").alias("__total"))
    by_m = (f.groupBy("merchant_key").agg(F.sum("txn_amount").alias("amount"))
            .filter(F.col("amount").isNotNull())
            .join(c.table("dim_merchant").select("merchant_key", "merchant_id"), "merchant_key"))
    top = by_m.orderBy(F.col("amount").desc(), F.col("merchant_id").asc()).limit(CONCENTRATION_TOP)
    return top.crossJoin(F.broadcast(total)).select(
        "merchant_id", "amount",
        F.round(F.lit(100.0) * F.col("amount").cast("double") / F.col("__total").cast("double"), 6).alias("share_pct"))
