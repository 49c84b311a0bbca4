"""Registered queries: Spark callables and their DuckDB oracle SQL.

Every Spark result goes through :func:`present` so both sides agree on
types: timestamps as 'yyyy-MM-dd HH:mm:ss' text, dates as 'yyyy-MM-dd',
decimals as DOUBLE, integers as BIGINT, doubles rounded to 6 places where
they are ratios. The oracle SQL applies the same conversions with
:func:`o_cols`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import catalog
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle_sql: str | None):
    def deco(fn):
        QUERIES[key] = lambda spark, sf_dir: present(fn(catalog.get(spark, sf_dir)))
        if oracle_sql is not None:
            ORACLE[key] = oracle_sql
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Column kinds for the oracle side.
TS_COLS = {"txn_ts"}
DATE_COLS = {"posting_date", "value_date", "date_of_birth", "kyc_review_date", "full_date"}
DEC_COLS = {"txn_amount", "amount_local", "fee_amount"}
INT_COLS = {"risk_score", "rules_fired", "txn_hour", "kyc_rank", "risk_rank", "weight", "yr", "qtr",
            "mth", "day_of_month", "day_of_week", "time_key", "hour_of_day", "date_key",
            "customer_key", "merchant_key", "channel_key", "card_key", "cust_txn_count",
            "acct_txns_same_hour", "txn_count", "_mirror_row_id"}


def o_col(name: str, src: str | None = None) -> str:
    e = src or name
    if name in TS_COLS:
        return f"strftime({e}, '%Y-%m-%d %H:%M:%S') AS {name}"
    if name in DATE_COLS:
        return f"strftime({e}, '%Y-%m-%d') AS {name}"
    if name in DEC_COLS:
        return f"CAST({e} AS DOUBLE) AS {name}"
    if name in INT_COLS:
        return f"CAST({e} AS BIGINT) AS {name}"
    return f"{e} AS {name}" if src else name


def o_cols(names) -> str:
    return ", ".join(o_col(n) for n in names)


def select_from(table: str, names, *ctes) -> str:
    return O.sql(f"SELECT {o_cols(names)} FROM {table}", table, *ctes)
