"""Deterministic duplicate removal: keep the lowest key per business key.

A ``row_number()`` window over the business key sorts every group in one
task -- and the all-NULL group (or a mass duplicate) can hold a third of the
rows. Instead the survivor key of each group is found by a partial
aggregate (``min`` combines map-side, so a hot group costs one row per
task), and rows are kept by a semi join on the unique row key, whose
shuffle is uniform. NULL business keys group together, as in a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEDUP_KEYS = ("txn_id", "txn_amount", "merchant_name", "txn_ts")


def survivors(df: DataFrame, keys=DEDUP_KEYS, order_key: str = "_mirror_row_id") -> DataFrame:
    """One row per business key: the surviving row key."""
    return df.groupBy(*keys).agg(F.min(order_key).alias(order_key)).select(order_key)


def keep_first(df: DataFrame, keys=DEDUP_KEYS, order_key: str = "_mirror_row_id") -> DataFrame:
    """Rows whose key is the lowest of their business-key group."""
    return df.join(survivors(df, keys, order_key), order_key, "left_semi")


def keep_first_window(df: DataFrame, keys=DEDUP_KEYS, order_key: str = "_mirror_row_id") -> DataFrame:
    """Window form (reference path for tests)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(order_key)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
