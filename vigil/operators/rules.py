"""Explainable risk rules: flags, weighted score, band.

Each rule is data: an id, a name, a weight and a Column factory over the
enriched row. A condition that is NULL counts as not fired. Flags are
computed once and the score and the fired count are derived from them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    weight: int
    condition: Callable[[], Column]


# ---------------------------------------------------------------------------
# The active rule set (id, name, weight, condition).
# ---------------------------------------------------------------------------
CNP_ENTRY_MODES = ("ECOM", "E-COMMERCE", "KEYED", "MANUAL")
HIGH_RISK_MCC = ("6011", "4829", "7995")
AMOUNT_PCT_THRESHOLD = 0.95
ODD_HOURS = (1, 5)
VELOCITY_MIN = 2
NEW_MERCHANT_MIN_HISTORY = 20

RULES = [
    Rule("R02", "card_not_present", 25, lambda: F.col("entry_mode").isin(*CNP_ENTRY_MODES)),
    Rule("R03", "amount_anomaly", 30, lambda: F.col("amt_pct_in_customer") >= AMOUNT_PCT_THRESHOLD),
    Rule("R04", "odd_hour", 15, lambda: F.col("txn_hour").between(*ODD_HOURS)),
    Rule("R05", "velocity", 30, lambda: F.col("acct_txns_same_hour") >= VELOCITY_MIN),
    Rule("R06", "new_merchant", 10, lambda: F.col("first_seen_merchant")
         & (F.col("cust_txn_count") >= NEW_MERCHANT_MIN_HISTORY)),
    Rule("R07", "high_risk_mcc", 25, lambda: F.col("merchant_mcc").isin(*HIGH_RISK_MCC)),
    Rule("R09", "declined", 10, lambda: F.col("auth_approved") == F.lit(False)),
]

# Retired rules: available, not in the score (no weight was ever set: 0).
RETIRED = [
    Rule("R01", "cross_border", 0, lambda: F.col("txn_currency") != F.col("account_currency")),
    Rule("R08", "round_amount", 0, lambda: (F.col("txn_amount") % 100 == 0) & (F.col("txn_amount") != 0)),
]

# Band thresholds: score >= HIGH -> HIGH, >= MEDIUM -> MEDIUM, else LOW.
BAND_HIGH = 60
BAND_MEDIUM = 30


def flags(df: DataFrame, rules=RULES) -> DataFrame:
    """One boolean column per rule; NULL conditions are FALSE."""
    return df.withColumns({r.name: F.coalesce(r.condition(), F.lit(False)) for r in rules})


def score(df: DataFrame, rules=RULES) -> DataFrame:
    """Flags, ``risk_score`` (sum of weights) and ``rules_fired`` (count)."""
    out = flags(df, rules)
    s = sum((F.when(F.col(r.name), F.lit(r.weight)).otherwise(F.lit(0)) for r in rules), F.lit(0))
    n = sum((F.when(F.col(r.name), F.lit(1)).otherwise(F.lit(0)) for r in rules), F.lit(0))
    return out.withColumns({"risk_score": s.cast("int"), "rules_fired": n.cast("int")})


def band(score_col="risk_score", high: int = BAND_HIGH, medium: int = BAND_MEDIUM) -> Column:
    s = F.col(score_col) if isinstance(score_col, str) else score_col
    return (F.when(s >= high, F.lit("HIGH")).when(s >= medium, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def max_score(rules=RULES) -> int:
    return sum(r.weight for r in rules)


def rule_table(spark, rules=RULES) -> DataFrame:
    """(rule_id, rule_name, weight) as a DataFrame (seven literal rows)."""
    return spark.createDataFrame([(r.rule_id, r.name, r.weight) for r in rules],
                                 "rule_id string, rule_name string, weight int")
