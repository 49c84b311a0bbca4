"""Rule and score analyses (G2-G12). Every one returns a DataFrame.

Scale notes: each analysis is one partially-aggregated pass over the scored
or fact rows. Quantiles and the threshold curve are computed from the score
histogram (one row per distinct score, at most ``max_score + 1`` rows), so
no step gathers raw rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rules as R

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------
TOO_COMMON_PCT = 50.0
TOO_RARE_PCT = 0.5
SCORE_BAND_EDGES = (20, 40, 60, 80)  # labels 0-19, 20-39, 40-59, 60-79, 80+
HIST_WIDTH = 5
ALERT_THRESHOLD = 60
THRESHOLDS = (10, 20, 30, 40, 50, 60, 70, 80, 90)
ANALYST_ALERTS_PER_YEAR = 50000
DATA_SPAN_YEARS = 2.5
DISCRIMINATION_MIN_GROUP = 1000


def pct(num, den):
    """100 * num / den as DOUBLE, NULL when den is 0."""
    return F.try_divide(F.lit(100.0) * num.cast("double"), den.cast("double"))


def _rule_rows(rule_set):
    return F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.name).alias("rule_name"),
                              F.lit(r.weight).alias("weight"), F.col(f"__n_{r.name}").alias("firings"))
                     for r in rule_set])


def fire_rates(scored: DataFrame, rule_set=R.RULES) -> DataFrame:
    """Share of rows on which each rule fires, with a usability verdict."""
    agg = scored.agg(F.count(F.lit(1)).alias("__rows"),
                     *[F.count_if(F.col(r.name)).alias(f"__n_{r.name}") for r in rule_set])
    x = agg.select("__rows", F.explode(_rule_rows(rule_set)).alias("r")).select("__rows", "r.*")
    p = pct(F.col("firings"), F.col("__rows"))
    verdict = (F.when(p > TOO_COMMON_PCT, "too common").when(p < TOO_RARE_PCT, "too rare")
               .otherwise("usable"))
    return x.select("rule_id", "rule_name", "weight", "firings", p.alias("fire_pct"),
                    verdict.alias("verdict"))


def rule_effectiveness(fact_alert: DataFrame, dim_rule: DataFrame, fact_txn: DataFrame) -> DataFrame:
    """Firings per rule and share of transactions (rule dim: 7 rows)."""
    total = fact_txn.agg(F.count(F.lit(1)).alias("__total"))
    by_rule = fact_alert.groupBy("rule_id").agg(F.count(F.lit(1)).alias("firings"))
    return (by_rule.join(F.broadcast(dim_rule.select("rule_id", "rule_name")), "rule_id")
            .crossJoin(F.broadcast(total))  # one row
            .select("rule_id", "rule_name", "firings", pct(F.col("firings"), F.col("__total")).alias("pct_of_txns")))


def share_of_total(df: DataFrame, count_col: str = "n", name: str = "pct") -> DataFrame:
    """Count / sum(count) over the whole *aggregated* result (small)."""
    return df.withColumn(name, pct(F.col(count_col), F.sum(count_col).over(Window.partitionBy())))


def score_band_label(score="risk_score"):
    s = F.col(score)
    e = SCORE_BAND_EDGES
    return (F.when(s < e[0], "0-19").when(s < e[1], "20-39").when(s < e[2], "40-59")
            .when(s < e[3], "60-79").otherwise("80+"))


def score_bands(scored: DataFrame) -> DataFrame:
    """Rows per 20-point score band with share."""
    g = scored.groupBy(score_band_label().alias("score_band")).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(g)


def score_summary(scored: DataFrame) -> DataFrame:
    """Min, mean, max, sample stddev of the score."""
    return scored.agg(F.min("risk_score").alias("min_score"),
                      F.round(F.avg("risk_score"), 6).alias("mean_score"),
                      F.max("risk_score").alias("max_score"),
                      F.round(F.stddev_samp("risk_score"), 6).alias("stddev_score"))


def score_histogram(df: DataFrame, flag_cols=()) -> DataFrame:
    """(risk_score, n, sum of each flag): one row per distinct score."""
    return df.groupBy("risk_score").agg(F.count(F.lit(1)).alias("n"),
                                        *[F.count_if(F.col(c)).alias(f"__n_{c}") for c in flag_cols])


def quantile_cont_from_hist(hist: DataFrame, q: float, value="risk_score", n="n") -> DataFrame:
    """Exact linear-interpolated quantile from a (value, count) histogram.

    The histogram is small (one row per distinct value), so the running
    count window over it is cheap; result is a one-row DataFrame."""
    w = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.select(value, n).withColumn("__cum", F.sum(n).over(w))
    tot = F.max("__cum")
    stats = h.agg(tot.alias("__N"))
    pos = F.lit(q) * (F.col("__N") - 1).cast("double")
    j = h.crossJoin(F.broadcast(stats)).withColumn("__pos", pos)
    lo_i = F.floor("__pos")
    hi_i = F.ceil("__pos")
    # value at 0-based index i: smallest value whose running count > i
    v = j.agg(F.min(F.when(F.col("__cum") > lo_i, F.col(value))).alias("__lo"),
              F.min(F.when(F.col("__cum") > hi_i, F.col(value))).alias("__hi"),
              F.first("__pos").alias("__pos"))
    frac = F.col("__pos") - F.floor("__pos")
    return v.select((F.col("__lo") + (F.col("__hi") - F.col("__lo")) * frac).cast("double").alias("q"))


def decile_lift(scored: DataFrame, rule_set=R.RULES) -> DataFrame:
    """Share of each rule firing in the top decile (score >= q90) vs the
    bottom decile (score <= q10); all from the score histogram."""
    names = [r.name for r in rule_set]
    hist = score_histogram(scored, names)
    q90 = quantile_cont_from_hist(hist, 0.9).withColumnRenamed("q", "q90")
    q10 = quantile_cont_from_hist(hist, 0.1).withColumnRenamed("q", "q10")
    j = hist.crossJoin(F.broadcast(q90)).crossJoin(F.broadcast(q10))
    top = F.col("risk_score") >= F.col("q90")
    bot = F.col("risk_score") <= F.col("q10")
    aggs = [F.max("q90").alias("q90"), F.max("q10").alias("q10"),
            F.sum(F.when(top, F.col("n"))).alias("__top_n"), F.sum(F.when(bot, F.col("n"))).alias("__bot_n")]
    for c in names:
        aggs += [F.sum(F.when(top, F.col(f"__n_{c}"))).alias(f"__t_{c}"),
                 F.sum(F.when(bot, F.col(f"__n_{c}"))).alias(f"__b_{c}")]
    a = j.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.name).alias("rule_name"),
                              pct(F.col(f"__t_{r.name}"), F.col("__top_n")).alias("top_pct"),
                              pct(F.col(f"__b_{r.name}"), F.col("__bot_n")).alias("bottom_pct"))
                     for r in rule_set])
    return (a.select("q90", "q10", F.explode(rows).alias("r"))
            .select("r.rule_id", "r.rule_name", F.round("r.top_pct", 6).alias("top_pct"),
                    F.round("r.bottom_pct", 6).alias("bottom_pct"),
                    F.round("q90", 6).alias("q90"), F.round("q10", 6).alias("q10")))


def discrimination(df: DataFrame, group_col: str, value_col: str, label: str,
                   min_group: int = DISCRIMINATION_MIN_GROUP) -> DataFrame:
    """How far per-group means move, relative to their mean (in %).
    Groups with at most ``min_group`` rows are ignored."""
    g = (df.filter(F.col(group_col).isNotNull() & (F.trim(F.col(group_col)) != ""))
         .groupBy(group_col).agg(F.avg(value_col).alias("m"), F.count(F.lit(1)).alias("c"))
         .filter(F.col("c") > min_group))
    a = g.agg(F.count(F.lit(1)).alias("groups"), F.stddev_samp("m").alias("sd"), F.avg("m").alias("mean"))
    return a.select(F.lit(label).alias("measure"), "groups",
                    F.round("sd", 6).alias("sd_of_means"), F.round("mean", 6).alias("mean_of_means"),
                    F.round(F.try_divide(F.lit(100.0) * F.col("sd"), F.col("mean")), 6).alias("cv_pct"))


def band_mix(fact_txn: DataFrame) -> DataFrame:
    """Transactions per risk band with share."""
    return share_of_total(fact_txn.groupBy("risk_band").agg(F.count(F.lit(1)).alias("n")))


def histogram5(fact_txn: DataFrame, width: int = HIST_WIDTH, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """Score histogram in buckets of ``width`` with the alert threshold marked."""
    b = (F.floor(F.col("risk_score") / width) * width).cast("long")
    g = fact_txn.groupBy(b.alias("score_bucket")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("at_or_above_threshold", F.col("score_bucket") >= threshold)


def cofiring(fact_txn: DataFrame) -> DataFrame:
    """Transactions by number of rules fired x band."""
    return fact_txn.groupBy("rules_fired", "risk_band").agg(F.count(F.lit(1)).alias("n"))


def threshold_tradeoff(labelled: DataFrame, label: str, thresholds=THRESHOLDS) -> DataFrame:
    """G11, for any boolean outcome column ``label`` (NULL is false): alerts, precision, recall, FP rate and analyst cost per threshold.

    One pass: histogram by (score, label), at most 2 x (max score + 1)
    rows, crossed with the nine thresholds."""
    hist = labelled.groupBy("risk_score").agg(F.count(F.lit(1)).alias("n"),
                                              F.count_if(F.col(label)).alias("f"))
    spark = labelled.sparkSession
    thr = spark.createDataFrame([(t,) for t in thresholds], "thr int")
    j = hist.crossJoin(F.broadcast(thr))
    above = F.col("risk_score") >= F.col("thr")
    a = j.groupBy("thr").agg(F.sum("n").alias("total"),
                             F.sum(F.when(above, F.col("n")).otherwise(0)).alias("alerts"),
                             F.sum(F.when(above, F.col("f")).otherwise(0)).alias("tp"),
                             F.sum(F.when(~above, F.col("f")).otherwise(0)).alias("fn"))
    prec = F.when(F.col("alerts") > 0, F.col("tp").cast("double") / F.col("alerts").cast("double")).otherwise(0.0)
    rec = F.when((F.col("tp") + F.col("fn")) > 0,
                 F.col("tp").cast("double") / (F.col("tp") + F.col("fn")).cast("double")).otherwise(0.0)
    ay = F.col("alerts").cast("double") / F.lit(float(ANALYST_ALERTS_PER_YEAR))
    return a.select("thr", "alerts", F.round(pct(F.col("alerts"), F.col("total")), 6).alias("alert_pct"),
                    "tp", "fn", F.round(prec * 100.0, 6).alias("precision_pct"),
                    F.round(rec * 100.0, 6).alias("recall_pct"),
                    F.round((F.lit(1.0) - prec) * 100.0, 6).alias("fp_rate_pct"),
                    F.round(ay, 6).alias("analyst_years"),
                    F.round(ay / F.lit(DATA_SPAN_YEARS), 6).alias("fte"))
