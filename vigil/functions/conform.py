"""Table-driven conformance: many spellings of one concept to one code.

``conform(col, mapping)`` turns ``{code: [spellings]}`` into one searched
CASE over ``upper(trim(coalesce(col, '')))``; the first matching code wins
and anything unmapped is NULL. Every mapping below is data, not code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import NULLISH_PARITY, is_nullish, raw_key

# ---------------------------------------------------------------------------
# The spellings each code accepts (compared after upper/trim).
# ---------------------------------------------------------------------------
COUNTRY = {"MY": ["MY", "MYS", "MALAYSIA", "458"]}
TXN_TYPE = {"DEBIT": ["DEBIT", "DR", "D"], "CREDIT": ["CREDIT", "CR", "C"]}
KYC = {
    "VERIFIED": ["VERIFIED", "V"],
    "PENDING": ["PENDING", "P"],
    "REJECTED": ["REJECTED"],
    "EXPIRED": ["EXPIRED"],
    "NOT_STARTED": ["NOT STARTED", "INCOMPLETE"],
}
CHANNEL = {
    "MOBILE": ["MOBILE", "MOBILE APP"],
    "INTERNET": ["WEB", "IB", "INTERNET BANKING"],
    "ATM": ["ATM"],
    "BRANCH": ["BRANCH"],
    "CALL_CENTRE": ["CALL CENTRE", "CALL CENTER"],
    "POS": ["POS"],
    "OTHER": ["API", "AGENT"],
}
CARD_BRAND = {
    "VISA": ["VISA"],
    "MASTERCARD": ["MASTERCARD", "MC"],
    "AMEX": ["AMEX", "AMERICAN EXPRESS"],
    "MYDEBIT": ["MYDEBIT"],
    "UNIONPAY": ["UNIONPAY"],
}
# Compared after lower/trim.
GENDER = {"M": ["m", "male", "1"], "F": ["f", "female", "2"]}
RISK_RATING = {
    "LOW": ["LOW", "L", "1"],
    "MEDIUM": ["MEDIUM", "MED", "M", "2"],
    "HIGH": ["HIGH", "H", "3"],
}
APPROVED_CODES = ["00", "0", "000", "APPROVED"]


def conform(c, mapping: dict, case: str = "upper", key: Column | None = None) -> Column:
    """Map spellings to codes; unmapped values are NULL."""
    key = raw_key(c) if key is None else key
    key = F.upper(key) if case == "upper" else F.lower(key)
    out = None
    for code, spellings in mapping.items():
        cond = key.isin(*spellings)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out.otherwise(F.lit(None).cast("string"))


def country(c, key: Column | None = None) -> Column:
    return conform(c, COUNTRY, key=key)


def txn_type(c, key: Column | None = None) -> Column:
    return conform(c, TXN_TYPE, key=key)


def kyc(c, key: Column | None = None) -> Column:
    return conform(c, KYC, key=key)


def channel(c, key: Column | None = None) -> Column:
    return conform(c, CHANNEL, key=key)


def card_brand(c, key: Column | None = None) -> Column:
    return conform(c, CARD_BRAND, key=key)


def gender(c, key: Column | None = None) -> Column:
    return conform(c, GENDER, case="lower", key=key)


def risk_rating(c, key: Column | None = None) -> Column:
    return conform(c, RISK_RATING, key=key)


def auth_approved(c, nullish=NULLISH_PARITY, key: Column | None = None) -> Column:
    """Approval codes TRUE, look-alikes NULL, any other response FALSE
    (so a leaked 'NA' counts as declined)."""
    k = raw_key(c) if key is None else key
    return (F.when(F.upper(k).isin(*APPROVED_CODES), F.lit(True))
            .when(is_nullish(c, nullish, k), F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)))
