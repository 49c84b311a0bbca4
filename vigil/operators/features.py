"""Window features the rules read (W1-W4), built to survive skewed keys.

Columns added:

* ``txn_hour``             hour of ``txn_ts``
* ``cust_txn_count``       rows of the same customer (W1; the NULL customer is one group)
* ``amt_pct_in_customer``  percent_rank of the amount inside the customer's rows (W2);
                           NULL when customer or amount is NULL or the customer has < 5 rows
* ``acct_txns_same_hour``  rows of the same account in the same clock hour (W3)
* ``first_seen_merchant``  first row of the (customer, merchant) pair by (txn_ts, key) (W4)

Orderings put NULLs last, as an ascending SQL sort does in most engines.

Skew. Any customer (or the NULL customer), amount or account may own a third
of all rows, so no step sorts the rows of one key in one task, and there is one
path for all keys, without thresholds. All work is on a narrow projection:

* W1 and W2 come from the histogram (customer, amount, rows), a partial
  aggregate. The histogram is range-partitioned on (customer, amount), so a
  customer gets tasks in proportion to its different amounts; running sums
  inside a range plus one offset per (range, customer) are exact ranks. Equal
  amounts are one histogram row, hence ties are exact. The ranged histogram is
  checkpointed once: all readers and retried tasks see the same ranges.
* The NULL customer is only counted, never ranked: its W2 is NULL by rule.
* W3 is a partial aggregate, W4 a partial ``min(struct(ts, key))``.

The results are joined back on narrow rows (AQE splits a join partition that a
hot key makes large) and then once, on the unique row key, to the full rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MIN_HISTORY = 5

_ID = "_mirror_row_id"


def _ts_order():
    return [F.col("txn_ts").asc_nulls_last(), F.col(_ID).asc()]


def _pct_gate(pct, n):
    return (F.when(F.col("customer_id").isNull() | F.col("txn_amount").isNull(), F.lit(None).cast("double"))
            .when(n < MIN_HISTORY, F.lit(None).cast("double"))
            .otherwise(pct))


def _first_gate(first):
    return (F.when(F.col("customer_id").isNull() | F.col("merchant_id").isNull(), F.lit(False))
            .otherwise(F.coalesce(first, F.lit(False))))


def add_windows_plain(df: DataFrame) -> DataFrame:
    """Textbook form with three windows. Correct, but a hot customer is
    sorted by one task. Kept as the reference path for tests."""
    wc = Window.partitionBy("customer_id")
    wcm = Window.partitionBy("customer_id", "merchant_id").orderBy(*_ts_order())
    n = F.count(F.lit(1)).over(wc)
    pct = F.percent_rank().over(wc.orderBy(F.col("txn_amount").asc_nulls_last()))
    return (df.withColumn("txn_hour", F.hour("txn_ts"))
            .withColumn("cust_txn_count", n)
            .withColumn("amt_pct_in_customer", _pct_gate(pct, F.col("cust_txn_count")))
            .withColumn("first_seen_merchant", _first_gate(F.row_number().over(wcm) == 1))
            .withColumn("acct_txns_same_hour", F.count(F.lit(1)).over(
                Window.partitionBy("account_no", F.date_trunc("hour", "txn_ts")))))


def amount_ranks(narrow: DataFrame, ranges: int | None = None) -> DataFrame:
    """``__c, __a, __n, __less``: for each customer and amount the customer's rows and those with a smaller amount."""
    spark = narrow.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hist = (narrow.filter(F.col("customer_id").isNotNull())
            .groupBy(F.col("customer_id").alias("__c"), F.col("txn_amount").alias("__a")).agg(F.count(F.lit(1)).alias("__m")))
    ranged = (hist.repartitionByRange(ranges, F.col("__c").asc(), F.col("__a").asc_nulls_last())
              .withColumn("__p", F.spark_partition_id()).checkpoint(eager=True))
    # At most one row per range and customer that is in it.
    per = ranged.groupBy("__c", "__p").agg(F.sum("__m").alias("__pm"))
    whole = Window.partitionBy("__c")
    before = whole.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("__c", "__p", F.coalesce(F.sum("__pm").over(before), F.lit(0)).alias("__off"), F.sum("__pm").over(whole).alias("__n"))
    inside = (Window.partitionBy("__p", "__c").orderBy(F.col("__a").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("__l", F.coalesce(F.sum("__m").over(inside), F.lit(0)))
    return local.join(per, ["__c", "__p"]).select("__c", "__a", "__n", (F.col("__l") + F.col("__off")).alias("__less"))


def first_rows(narrow: DataFrame) -> DataFrame:
    """Keys of the earliest row (NULL time last, then key) of each customer and merchant."""
    return (narrow.filter(F.col("customer_id").isNotNull() & F.col("merchant_id").isNotNull())
            .groupBy("customer_id", "merchant_id")
            .agg(F.min(F.struct(F.col("txn_ts").isNull().alias("a"), F.col("txn_ts").alias("b"), F.col(_ID).alias("c"))).alias("__f"))
            .select(F.col("__f.c").alias("__first_id")))


def hourly_counts(df: DataFrame) -> DataFrame:
    """W3 counts per (account, clock hour): a partial aggregate that reads
    only ``account_no`` and ``txn_ts`` (column-pruned scan)."""
    return (df.groupBy(F.col("account_no").alias("__acct"), F.date_trunc("hour", "txn_ts").alias("__hr2"))
            .agg(F.count(F.lit(1)).alias("acct_txns_same_hour")))


def add_hourly_velocity(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """W3 as aggregate + null-safe join back (NULL account / NULL hour rows
    form their own groups, as a window partition would)."""
    counts = hourly_counts(df) if counts is None else counts
    keyed = df.withColumn("__hr", F.date_trunc("hour", "txn_ts"))
    cond = keyed["account_no"].eqNullSafe(counts["__acct"]) & keyed["__hr"].eqNullSafe(counts["__hr2"])
    return keyed.join(counts, cond, "left").drop("__hr", "__acct", "__hr2")


def add(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Add W1-W4 (and ``txn_hour``) to silver rows. ``ranges``: tasks for the histogram (default: shuffle partitions)."""
    narrow = df.select(_ID, "customer_id", "merchant_id", "account_no", "txn_ts", "txn_amount")
    ranks = amount_ranks(narrow, ranges)
    nobody = narrow.filter(F.col("customer_id").isNull()).agg(F.count(F.lit(1)).alias("__nobody"))
    same = (F.col("customer_id") == F.col("__c")) & F.col("txn_amount").eqNullSafe(F.col("__a"))
    x = narrow.join(ranks, same, "left").crossJoin(F.broadcast(nobody))  # one row
    n = F.coalesce("__n", "__nobody")
    pct = F.when(F.col("__n") > 1, F.col("__less").cast("double") / (F.col("__n") - 1).cast("double"))
    x = add_hourly_velocity(x, hourly_counts(df))
    firsts = first_rows(narrow)
    x = x.join(firsts, F.col(_ID) == F.col("__first_id"), "left")
    feats = x.select(F.col(_ID).alias("__id"), n.alias("cust_txn_count"), _pct_gate(pct, n).alias("amt_pct_in_customer"),
                     _first_gate(F.col("__first_id").isNotNull()).alias("first_seen_merchant"), "acct_txns_same_hour")
    return (df.join(feats, F.col(_ID) == F.col("__id")).drop("__id").withColumn("txn_hour", F.hour("txn_ts")))
