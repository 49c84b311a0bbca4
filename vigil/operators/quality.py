"""Data quality, reconciliation and verification.

Every check is a DataFrame computed by Spark; wide checks are one
aggregate over all columns (one scan) then unpivoted with ``stack``-style
``explode``. Only tiny results (a few rows) reach the driver, in the check
runner.
"""

from __future__ import annotations

import traceback
from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean


def _unpivot(agg_row: DataFrame, names: list[str], value: str, name_col: str = "column_name") -> DataFrame:
    arr = F.array(*[F.struct(F.lit(n).alias(name_col), F.col(f"`__v_{n}`").alias(value)) for n in names])
    return agg_row.select(F.explode(arr).alias("__r")).select("__r.*")


def _pct(num, den):
    return F.lit(100.0) * num.cast("double") / den.cast("double")


def recovery(silver: DataFrame, columns: list[str]) -> DataFrame:
    """H1: share of rows carrying a real value after cleaning, per column."""
    n = F.count(F.lit(1))
    agg = silver.agg(*[_pct(F.count(c), n).alias(f"__v_{c}") for c in columns])
    return _unpivot(agg, columns, "pct_non_null")


def conformance(silver: DataFrame, columns: list[str]) -> DataFrame:
    """H2: distinct values left after conformance, per column."""
    agg = silver.agg(*[F.count_distinct(c).alias(f"__v_{c}") for c in columns])
    return _unpivot(agg, columns, "distinct_values")


def duplicates(df: DataFrame, key: str = "txn_id") -> DataFrame:
    """H3: keys appearing more than once, surplus rows and their share."""
    g = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    total = df.agg(F.count(F.lit(1)).alias("__rows"))
    a = g.agg(F.count(F.lit(1)).alias("dup_ids"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("surplus_rows"))
    return a.crossJoin(F.broadcast(total)).select("dup_ids", "surplus_rows",
                                     _pct(F.col("surplus_rows"), F.col("__rows")).alias("surplus_pct"))


def check_schema(df: DataFrame, expected: list[str], text_only: bool = True, key: str | None = None) -> DataFrame:
    """H4 / K5: expected header vs actual (metadata only, no scan)."""
    spark = df.sparkSession
    actual = [f.name for f in df.schema.fields]
    rows = [("missing", c, None) for c in expected if c not in actual]
    rows += [("extra", c, None) for c in actual if c not in expected]
    if text_only:
        rows += [("not_text", f.name, f.dataType.simpleString()) for f in df.schema.fields
                 if f.name != key and not isinstance(f.dataType, T.StringType)]
    if [c for c in actual if c in expected] != [c for c in expected if c in actual]:
        rows.append(("order", None, None))
    return spark.createDataFrame(rows, "issue string, column_name string, detail string")


def mess_rates(raw: DataFrame, columns: list[str], junk=clean.RAW_JUNK) -> DataFrame:
    """H5: share of NULL or trimmed null look-alike values per raw column
    (exact-case junk list), one scan."""
    n = F.count(F.lit(1))
    agg = raw.agg(*[_pct(F.count_if(F.col(c).isNull() | F.trim(F.col(c)).isin(*junk)), n).alias(f"__v_{c}")
                    for c in columns])
    return _unpivot(agg, columns, "mess_pct")


# Layouts a typed load would accept as-is.
DRIFT_CHECKS = {
    "posting_date_iso": ("posting_date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    "txn_amount_plain": ("txn_amount", r"^-?[0-9]+(\.[0-9]+)?$"),
    "amount_local_plain": ("amount_local", r"^-?[0-9]+(\.[0-9]+)?$"),
    "txn_datetime_iso": ("txn_datetime", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}$"),
}


def format_drift(raw: DataFrame, checks=DRIFT_CHECKS) -> DataFrame:
    """H6: share of raw values already in a clean typed layout."""
    n = F.count(F.lit(1))
    agg = raw.agg(*[_pct(F.count_if(F.coalesce(F.col(c).rlike(p), F.lit(False))), n).alias(f"__v_{k}")
                    for k, (c, p) in checks.items()])
    return _unpivot(agg, list(checks), "pct_parse", "check")


# The types that a typed load would ask for.
PARSE_CHECKS = {"posting_date": "date", "txn_amount": "decimal(18,2)", "amount_local": "decimal(18,2)", "txn_datetime": "timestamp"}


def parse_rates(raw: DataFrame, checks=PARSE_CHECKS) -> DataFrame:
    """H6: of each column's values the share that a cast to its type accepts as it is, one scan."""
    rate = lambda c, kind: _pct(F.count(F.col(c).try_cast(kind)), F.greatest(F.count(c), F.lit(1)))
    return _unpivot(raw.agg(*[rate(c, kind).alias(f"__v_{c}") for c, kind in checks.items()]), list(checks), "pct_parse")


def parse_samples(raw: DataFrame, checks=PARSE_CHECKS, top: int = 3) -> DataFrame:
    """H6: the most frequent values of each column that the cast refuses (a report of ``top`` values). One scan; equal values
    are counted before they move, and the ranking keeps ``top`` rows a task."""
    every = F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(F.col(c).try_cast(kind).isNull(), F.col(c)).alias("value")) for c, kind in checks.items()])
    n = raw.select(F.explode(every).alias("x")).select("x.*").filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc("value"))
    return n.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top)


def spellings(raw: DataFrame, columns: list[str], top: int = 6) -> DataFrame:
    """H6: distinct spellings per column and the ``top`` most frequent ones
    (ties broken by value). Counts are aggregated first, so the ranking
    window runs over distinct values only."""
    parts = []
    for c in columns:
        g = (raw.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("value"))
             .agg(F.count(F.lit(1)).alias("n")).withColumn("column_name", F.lit(c)))
        parts.append(g)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # The ranking window holds only row_number with a "<= top" filter, so
    # Spark plans a partial top-k per task below the exchange
    # (WindowGroupLimit): a column with billions of distinct values sends
    # at most ``top`` rows per task. Distinct counts come from an aggregate
    # (one row per column).
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc())
    ranked = u.withColumn("rnk", F.row_number().over(w)).filter(F.col("rnk") <= top)
    distinct = u.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    return (ranked.join(F.broadcast(distinct), "column_name")
            .select("column_name", "distinct_values", "rnk", "value", "n"))


def coherence(raw: DataFrame, junk=clean.RAW_JUNK) -> DataFrame:
    """Customers whose first name has more than one variant after
    lower/trim (look-alikes excluded)."""
    ok = (F.col("customer_id").isNotNull() & ~F.trim("customer_id").isin(*junk)
          & F.col("first_name").isNotNull() & ~F.trim("first_name").isin(*junk))
    g = (raw.filter(ok).groupBy("customer_id")
         .agg(F.count_distinct(F.lower(F.trim("first_name"))).alias("variants")).filter("variants > 1"))
    return g.agg(F.count(F.lit(1)).alias("incoherent_customers"))


def fingerprint(df: DataFrame, key: str = "_mirror_row_id", width: int = 5) -> DataFrame:
    """H9: distinct keys per bucket = first ``width`` hex digits of md5(key)."""
    b = F.substring(F.md5(F.col(key).cast("string")), 1, width)
    return df.groupBy(b.alias("bucket")).agg(F.count_distinct(key).alias("n_keys"))


def fingerprint_diff(a: DataFrame, b: DataFrame, key: str = "_mirror_row_id", width: int = 5) -> DataFrame:
    """H9: buckets whose distinct-key counts differ, then the keys in those
    buckets present on one side only. Catches a dropped row plus an added
    row that leave total counts equal."""
    fa, fb = fingerprint(a, key, width), fingerprint(b, key, width)
    diff = (fa.withColumnRenamed("n_keys", "na").join(fb.withColumnRenamed("n_keys", "nb"), "bucket", "full_outer")
            .filter(~F.col("na").eqNullSafe(F.col("nb"))).select("bucket"))
    bkt = F.substring(F.md5(F.col(key).cast("string")), 1, width)
    # ``diff`` has at most 16 ** width rows (1,048,576 five-character
    # buckets at the default width): a proven bound for the broadcast.
    ka = a.select(key).withColumn("bucket", bkt).join(F.broadcast(diff), "bucket", "left_semi").distinct()
    kb = b.select(key).withColumn("bucket", bkt).join(F.broadcast(diff), "bucket", "left_semi").distinct()
    only_a = ka.join(kb, key, "left_anti").withColumn("side", F.lit("left_only"))
    only_b = kb.join(ka, key, "left_anti").withColumn("side", F.lit("right_only"))
    return only_a.unionByName(only_b).select("side", "bucket", key)


def referential(fact: DataFrame, fks: list[str]) -> DataFrame:
    """H7: per foreign key, share resolved to Unknown (-1) and NULL count."""
    n = F.count(F.lit(1))
    agg = fact.agg(*[_pct(F.count_if(F.col(k) == -1), n).alias(f"__u_{k}") for k in fks],
                   *[F.count_if(F.col(k).isNull()).alias(f"__n_{k}") for k in fks])
    arr = F.array(*[F.struct(F.lit(k).alias("fk"), F.col(f"__u_{k}").alias("unknown_pct"),
                             F.col(f"__n_{k}").alias("null_fks")) for k in fks])
    return agg.select(F.explode(arr).alias("r")).select("r.*")


def orphans(fact: DataFrame, dims: dict, fk_to_dim: dict) -> DataFrame:
    """For each foreign key the fact rows whose key has no row in its dimension, how many different keys these have
    and the least of them. One scan: all keys of a row become (fk, key) pairs, counted before they move; the distinct pairs
    meet the keys of all dimensions in one join. A NULL key is an orphan."""
    every = F.array(*[F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("long").alias("key")) for fk in fk_to_dim])
    pairs = fact.select(F.explode(every).alias("p")).select("p.*").groupBy("fk", "key").agg(F.count(F.lit(1)).alias("rows"))
    known = None
    for fk, (dim, dk) in fk_to_dim.items():
        d = dims[dim].select(F.lit(fk).alias("fk"), F.col(dk).cast("long").alias("key"))
        known = d if known is None else known.unionByName(d)
    lost = pairs.join(known, ["fk", "key"], "left_anti")
    none = fact.sparkSession.createDataFrame([(fk, None, 0) for fk in fk_to_dim], "fk string, key long, rows long")
    return lost.unionByName(none).groupBy("fk").agg(F.sum("rows").alias("orphan_rows"), F.count_if(F.col("rows") > 0).alias("orphan_keys"), F.min("key").alias("least_key"))


def dedup_recon(scored: DataFrame, deduped: DataFrame, key: str = "txn_id") -> DataFrame:
    """H8: scored -> deduped arithmetic, distinct and NULL ids, ids surviving twice."""
    s = scored.agg(F.count(F.lit(1)).alias("scored_rows"))
    d = deduped.agg(F.count(F.lit(1)).alias("deduped_rows"), F.count_distinct(key).alias("distinct_ids"),
                    F.count_if(F.col(key).isNull()).alias("null_ids"))
    twice = (deduped.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c"))
             .filter("c > 1").agg(F.count(F.lit(1)).alias("ids_surviving_twice")))
    return (s.crossJoin(F.broadcast(d)).crossJoin(F.broadcast(twice))
            .withColumn("removed", F.col("scored_rows") - F.col("deduped_rows"))
            .select("scored_rows", "deduped_rows", "removed", "distinct_ids", "null_ids", "ids_surviving_twice"))


def survivors(deduped: DataFrame, key: str = "txn_id", sample: int = 5) -> DataFrame:
    """H8: the first ids that survive more than once, with their rows (a report of ``sample`` ids)."""
    g = deduped.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return g.orderBy(key).limit(sample)


def record_run(metrics: DataFrame, path: str, run: int) -> None:
    """Keep a run's evidence, rows of ``metric, value``; a run is written once."""
    metrics.select("metric", F.col("value").cast("long").alias("value")).coalesce(1).write.mode("errorifexists").parquet(f"{path}/run={run:06d}")


def compare_runs(spark, path: str) -> DataFrame:
    """``run, metric, value, previous, moved`` for every run after the first: which metric moved, and in which run. A metric
    that a run lacks counts 0. There is a row for each run and metric at most."""
    kept = spark.read.schema("metric string, value long, run int").parquet(path)
    grid = kept.select("run").distinct().crossJoin(F.broadcast(kept.select("metric").distinct()))  # names of metrics: rules and counts
    full = grid.join(kept, ["run", "metric"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    full = full.withColumn("previous", F.lag("value").over(Window.partitionBy("metric").orderBy("run")))
    return full.filter(F.col("previous").isNotNull()).withColumn("moved", F.col("value") != F.col("previous")).select("run", "metric", "value", "previous", "moved")


def compare_firings(fact_alert: DataFrame, baseline: DataFrame) -> DataFrame:
    """Per-rule firings vs a baseline (rule_id, firings); mismatches show."""
    cur = fact_alert.groupBy("rule_id").agg(F.count(F.lit(1)).alias("firings"))
    b = baseline.select("rule_id", F.col("firings").alias("baseline"))
    j = cur.join(b, "rule_id", "full_outer")
    return j.select("rule_id", "firings", "baseline",
                    F.col("firings").eqNullSafe(F.col("baseline")).alias("matches"))


def flag_baseline(deduped: DataFrame, rule_set) -> DataFrame:
    """Per-rule firings recounted from the flags of the deduped rows."""
    agg = deduped.agg(*[F.count_if(F.col(r.name)).alias(f"__n_{r.name}") for r in rule_set])
    arr = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.col(f"__n_{r.name}").alias("firings"))
                    for r in rule_set])
    return agg.select(F.explode(arr).alias("r")).select("r.*").filter(F.col("firings") > 0)


def compare_counts(a: dict, b: dict) -> DataFrame:
    """Row counts of the same tables in two layers."""
    parts = []
    for name in sorted(set(a) & set(b)):
        ca = a[name].agg(F.count(F.lit(1)).alias("rows_a"))
        cb = b[name].agg(F.count(F.lit(1)).alias("rows_b"))
        parts.append(ca.crossJoin(F.broadcast(cb)).select(F.lit(name).alias("table_name"), "rows_a", "rows_b"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("equal", F.col("rows_a") == F.col("rows_b"))


def locate_key(df: DataFrame, key_col: str, value) -> DataFrame:
    """Which physical files hold a key, and how many visible rows."""
    return (df.filter(F.col(key_col) == F.lit(value))
            .select(F.col("_metadata.file_name").alias("file_name"))
            .groupBy("file_name").agg(F.count(F.lit(1)).alias("rows")))


def table_stats(spark, path: str) -> DataFrame:
    """File count and bytes of a table's folder, from the listing; no file is opened."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path", "length")
    return f.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def check_instants(df: DataFrame) -> DataFrame:
    """Timestamp columns must be instants, not local date-times."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), not isinstance(f.dataType, T.TimestampNTZType))
            for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return spark.createDataFrame(rows, "column_name string, data_type string, is_instant boolean")


def probe_key(silver: DataFrame, key: str = "txn_id", order_key: str = "_mirror_row_id") -> DataFrame:
    """The lowest row key whose business id has no duplicate twin."""
    single = silver.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("c"), F.min(order_key).alias(order_key)).filter("c = 1")
    return single.agg(F.min(order_key).alias(order_key))


def ranked(small: DataFrame, by: str, name: str) -> DataFrame:
    """A small result (a row for each column, rule, ...) with ``place`` by ``by`` descending, ``n`` and the ``mean``."""
    every = Window.partitionBy()
    return (small.withColumn("place", F.row_number().over(Window.orderBy(F.col(by).desc(), F.col(name).asc())))
            .withColumn("n", F.count(F.lit(1)).over(every)).withColumn("mean", F.avg(by).over(every)))


def trust(silver: DataFrame, by: str, present: dict[str, str], key: str) -> DataFrame:
    """For each value of ``by`` the rows, the share with a value in some columns, and the rows beyond the first of
    a business key."""
    shares = [F.round(_pct(F.sum(f"__p_{n}"), F.sum("__c")), 6).alias(n) for n in present]
    per = silver.groupBy(by, key).agg(F.count(F.lit(1)).alias("__c"), *[F.count(c).alias(f"__p_{n}") for n, c in present.items()])
    surplus = F.sum(F.when(F.col(key).isNotNull(), F.col("__c") - 1).otherwise(0)).alias("surplus_rows")
    return per.groupBy(by).agg(F.sum("__c").alias("rows"), *shares, surplus)


def probe_rows(df: DataFrame, n: int = 2, key: str = "txn_id", order_key: str = "_mirror_row_id") -> DataFrame:
    """the first ``n`` rows whose business id is there once (a top-n, as a probe needs only a few)."""
    single = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c"), F.min(order_key).alias(order_key)).filter("c = 1")
    first = single.orderBy(order_key).limit(n).select(order_key)
    return df.join(F.broadcast(first), order_key, "left_semi")  # n rows


def run_checks(spark, checks: list[tuple[str, str, Callable[[], bool]]]) -> DataFrame:
    """Run each check in isolation; PASS / FAIL / SKIP; an exception is
    a FAIL with its message. Each check returns True/False/None(skip)."""
    rows = []
    for cid, name, fn in checks:
        try:
            r = fn()
            status = "SKIP" if r is None else ("PASS" if r else "FAIL")
            rows.append((cid, name, status, None))
        except Exception as e:  # noqa: BLE001 - a failing check must not stop the run
            rows.append((cid, name, "FAIL", f"{type(e).__name__}: {e}"[:500] or traceback.format_exc()[-500:]))
    return spark.createDataFrame(rows, "check_id string, check_name string, status string, detail string")
