"""Registered queries: cleaners, conformers, silver, windows, scoring, dedup, star."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, conform
from ..operators import dedup, features, rules, silver, star
from ..sources import tables
from . import oracle as O
from .registry import o_cols, o_col, register, select_from

ID = "_mirror_row_id"


def _proj(c, cols: dict):
    return c.raw().select(F.col(ID), *[e.alias(n) for n, e in cols.items()])


def _oproj(cols: dict) -> str:
    sel = ", ".join(o_col(n, e) for n, e in cols.items())
    return O.sql(f"SELECT {ID}, {sel} FROM raw_txn", "raw_txn")


# ----------------------------------------------------------------- cleaners (B)
# Spark side as factories: Columns need an active session, oracle SQL does not.
_CLEAN = {
    "clean_text": (
        lambda: {n: clean.text(n) for n in ("txn_id", "account_no", "customer_id", "merchant_id", "first_name")},
        {n: O.o_text(n) for n in ("txn_id", "account_no", "customer_id", "merchant_id", "first_name")}),
    "clean_upper": (
        lambda: {n: clean.upper_text(n) for n in ("txn_status", "merchant_name", "entry_mode", "txn_currency",
                                                  "occupation", "addr_city", "last_name")},
        {n: O.o_upper(n) for n in ("txn_status", "merchant_name", "entry_mode", "txn_currency",
                                   "occupation", "addr_city", "last_name")}),
    "clean_money": (
        lambda: {n: clean.money(n) for n in ("txn_amount", "amount_local", "fee_amount")},
        {n: O.o_money(n) for n in ("txn_amount", "amount_local", "fee_amount")}),
    "clean_date": (
        lambda: {"posting_date": clean.date_multi("posting_date"), "value_date": clean.date_multi("value_date"),
                 "date_of_birth": clean.date_multi("dob"), "kyc_review_date": clean.date_multi("kyc_review_date")},
        {"posting_date": O.o_date("posting_date"), "value_date": O.o_date("value_date"),
         "date_of_birth": O.o_date("dob"), "kyc_review_date": O.o_date("kyc_review_date")}),
    "clean_ts": (lambda: {"txn_ts": clean.timestamp_multi("txn_datetime")},
                 {"txn_ts": O.o_ts("txn_datetime")}),
    "clean_flag": (lambda: {n: clean.flag(n) for n in ("pep_flag", "sanctions_hit")},
                   {n: O.o_flag(n) for n in ("pep_flag", "sanctions_hit")}),
    "clean_pattern": (
        lambda: {"merchant_mcc": clean.matching("merchant_mcc", silver.MCC_PATTERN),
                 "card_bin": clean.matching("card_bin", silver.BIN_PATTERN)},
        {"merchant_mcc": O.o_match("merchant_mcc", "^[0-9]{4}$"),
         "card_bin": O.o_match("card_bin", "^[0-9]{6}$")}),
    "scrape_number": (lambda: {"fraud_score_num": clean.scrape_number("fraud_score")},
                      {"fraud_score_num": O.o_scrape("fraud_score")}),
    "conform_country": (
        lambda: {n: conform.country(n) for n in ("nationality", "addr_country", "merchant_country")},
        {n: O.o_conform(n, conform.COUNTRY) for n in ("nationality", "addr_country", "merchant_country")}),
    "conform_txn_type": (lambda: {"txn_type": conform.txn_type("txn_type")},
                         {"txn_type": O.o_conform("txn_type", conform.TXN_TYPE)}),
    "conform_kyc": (lambda: {"kyc_status": conform.kyc("kyc_status")},
                    {"kyc_status": O.o_conform("kyc_status", conform.KYC)}),
    "conform_channel": (lambda: {"channel": conform.channel("channel")},
                        {"channel": O.o_conform("channel", conform.CHANNEL)}),
    "conform_card_brand": (lambda: {"card_brand": conform.card_brand("card_brand")},
                           {"card_brand": O.o_conform("card_brand", conform.CARD_BRAND)}),
    "conform_auth": (lambda: {"auth_approved": conform.auth_approved("auth_response")},
                     {"auth_approved": O.o_auth("auth_response")}),
    "conform_gender": (lambda: {"gender": conform.gender("gender")},
                       {"gender": O.o_conform("gender", conform.GENDER, "lower")}),
    "conform_risk": (lambda: {"risk_rating": conform.risk_rating("risk_rating")},
                     {"risk_rating": O.o_conform("risk_rating", conform.RISK_RATING)}),
}

for _key, (_spark_cols, _sql_cols) in _CLEAN.items():
    register(_key, _oproj(_sql_cols))(lambda c, _cols=_spark_cols: _proj(c, _cols()))


# ------------------------------------------------------------------ silver
@register("silver", select_from("silver", silver.SILVER_COLUMNS))
def q_silver(c):
    return silver.build(c.raw())


KEY_SLICE_N = 5000


@register("key_slice", O.sql(f"SELECT {o_cols(['_mirror_row_id', 'txn_id', 'txn_amount'])} "
                             f"FROM silver WHERE _mirror_row_id <= {KEY_SLICE_N}", "silver"))
def q_key_slice(c):
    return tables.key_slice(c.silver(), KEY_SLICE_N).select(ID, "txn_id", "txn_amount")


# ------------------------------------------------------------------ windows (W)
def _win(cols):
    return select_from("enriched", [ID] + cols)


@register("win_customer_count", _win(["customer_id", "cust_txn_count"]))
def q_win_customer_count(c):
    return features.add(c.silver()).select(ID, "customer_id", "cust_txn_count")


@register("win_amount_percentile", O.sql(
    f"SELECT {ID}, round(amt_pct_in_customer, 6) AS amt_pct_in_customer FROM enriched", "enriched"))
def q_win_amount_percentile(c):
    return features.add(c.silver()).select(ID, F.round("amt_pct_in_customer", 6).alias("amt_pct_in_customer"))


@register("win_velocity", _win(["account_no", "acct_txns_same_hour"]))
def q_win_velocity(c):
    return features.add(c.silver()).select(ID, "account_no", "acct_txns_same_hour")


@register("win_first_merchant", _win(["first_seen_merchant"]))
def q_win_first_merchant(c):
    return features.add(c.silver()).select(ID, "first_seen_merchant")


# Skew path forced on every customer (hot threshold 0): must equal the oracle too.
@register("win_skew_split", O.sql(
    f"SELECT {ID}, cust_txn_count, round(amt_pct_in_customer, 6) AS amt_pct_in_customer, "
    f"first_seen_merchant, acct_txns_same_hour FROM enriched", "enriched"))
def q_win_skew_split(c):
    return (features.add(c.silver())
            .select(ID, "cust_txn_count", F.round("amt_pct_in_customer", 6).alias("amt_pct_in_customer"),
                    "first_seen_merchant", "acct_txns_same_hour"))


# ------------------------------------------------------------------ scoring (E)
SCORED_COLS = [ID] + [r.name for r in rules.RULES] + ["risk_score", "rules_fired"]


@register("scored", select_from("scored", SCORED_COLS))
def q_scored(c):
    return c.scored().select(*SCORED_COLS)


@register("risk_band", O.sql(f"SELECT {ID}, CAST(risk_score AS BIGINT) AS risk_score, {O.BAND} AS risk_band "
                             "FROM scored", "scored"))
def q_risk_band(c):
    return c.scored().select(ID, "risk_score", rules.band().alias("risk_band"))


# -------------------------------------------------------------------- dedup
@register("dedup", select_from("deduped", [ID, "txn_id", "txn_amount", "merchant_name", "txn_ts"]))
def q_dedup(c):
    return dedup.keep_first(c.scored()).select(ID, "txn_id", "txn_amount", "merchant_name", "txn_ts")


# --------------------------------------------------------------------- star (E)
_DIM_COLS = {
    "dim_date": ["date_key", "full_date", "yr", "qtr", "mth", "month_name", "day_of_month",
                 "day_of_week", "day_name", "is_weekend"],
    "dim_customer": ["customer_key", "customer_id", *star.CUSTOMER_ATTRS, "kyc_rank", "ever_pep",
                     "ever_sanctioned", "risk_rank", "txn_count"],
    "dim_merchant": ["merchant_key", "merchant_id", "merchant_name", "merchant_mcc", "merchant_country",
                     "txn_count", "is_high_risk_mcc"],
    "dim_channel": ["channel_key", "channel", "entry_mode", "is_card_not_present"],
    "dim_card": ["card_key", "card_bin", "card_brand"],
}

for _name, _cols in _DIM_COLS.items():
    register(_name, select_from(_name, _cols))(lambda c, _n=_name, _cs=_cols: c.table(_n).select(*_cs))

_TIME = ["time_key", "hour_of_day", "hour_label", "day_part", "is_odd_hour"]


@register("dim_time", O.sql(f"""
SELECT {', '.join('t.' + x for x in _TIME)}, count(f._mirror_row_id) AS transactions
FROM dim_time t LEFT JOIN fact_transaction f ON f.time_key = t.time_key GROUP BY ALL""", "dim_time", "fact_transaction"))
def q_dim_time(c):
    """The hours with their transactions."""
    n = c.table("fact_transaction").groupBy("time_key").agg(F.count(F.lit(1)).alias("transactions"))
    return c.table("dim_time").join(n, "time_key", "left").select(*_TIME, F.coalesce("transactions", F.lit(0)).alias("transactions"))


@register("dim_risk_rule", O.sql("""
SELECT r.rule_id, r.rule_name, CAST(r.weight AS BIGINT) AS weight, count(a.rule_id) AS firings
FROM dim_risk_rule r LEFT JOIN fact_alert a ON a.rule_id = r.rule_id GROUP BY ALL""", "dim_risk_rule", "fact_alert"))
def q_dim_risk_rule(c):
    """The rules with their firings."""
    n = c.table("fact_alert").groupBy("rule_id").agg(F.count(F.lit(1)).alias("firings"))
    return c.table("dim_risk_rule").join(n, "rule_id", "left").select("rule_id", "rule_name", "weight", F.coalesce("firings", F.lit(0)).alias("firings"))


register("fact_transaction", select_from("fact_transaction", star.FACT_COLUMNS))(
    lambda c: c.table("fact_transaction"))
register("fact_alert", select_from("fact_alert", [ID, "rule_id", "weight"]))(
    lambda c: c.table("fact_alert"))


# Dense keys straight from the deduped rows (not the materialised dim):
@register("dense_key_customer", O.sql(
    "SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key "
    "FROM (SELECT DISTINCT customer_id FROM deduped WHERE customer_id IS NOT NULL)", "deduped"))
def q_dense_key_customer(c):
    from ..operators import keys
    d = c.deduped().filter(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    return keys.dense_key(d, [F.col("customer_id").asc()], "customer_key")
