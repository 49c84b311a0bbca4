"""Star schema: seven dimensions, two facts, explicit Unknown members.

Grain: ``fact_transaction`` one surviving row key; ``fact_alert`` one rule
firing on one transaction (natural key (row key, rule_id), no surrogate --
a surrogate would need a global sort over the largest table).

Attributes picked "any value" in a group are made deterministic: the value
of the lowest row key among rows where the attribute is not NULL
(``min_by`` skips NULL orderings; it is a partial aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keys, rules

UNKNOWN_KEY = -1
_ID = "_mirror_row_id"


def _first_non_null(c: str) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_ID))).alias(c)


# ---------------------------------------------------------------- dimensions

def dim_date(deduped: DataFrame) -> DataFrame:
    """Distinct observed dates of ``txn_ts``. Day of week 0 = Sunday."""
    d = (deduped.filter(F.col("txn_ts").isNotNull())
         .select(F.to_date("txn_ts").alias("full_date")).distinct())
    d = keys.dense_key(d, [F.col("full_date").asc()], "date_key")
    dow = F.dayofweek("full_date") - 1
    return d.select(
        "date_key", "full_date",
        F.year("full_date").alias("yr"), F.quarter("full_date").alias("qtr"),
        F.month("full_date").alias("mth"), F.date_format("full_date", "MMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format("full_date", "E").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"))


def dim_time(spark) -> DataFrame:
    """24 hours with label, day part and the odd-hour flag."""
    h = F.col("id").cast("int")
    part = (F.when(h.between(1, 5), "Overnight").when(h.between(6, 11), "Morning")
            .when(h.between(12, 17), "Afternoon").otherwise("Evening"))
    return spark.range(0, 24).select(
        h.alias("time_key"), h.alias("hour_of_day"),
        F.format_string("%02d:00", h).alias("hour_label"), part.alias("day_part"),
        h.between(1, 5).alias("is_odd_hour"))


# The customer's attributes.
CUSTOMER_ATTRS = ("first_name", "last_name", "gender", "date_of_birth", "occupation",
                  "addr_city", "addr_state", "nationality")


def dim_customer(deduped: DataFrame) -> DataFrame:
    """One row per customer; worst case wins for KYC, PEP, sanctions, risk."""
    kyc_rank = (F.when(F.col("kyc_status") == "VERIFIED", 0)
                .when(F.col("kyc_status").isNull(), 1).otherwise(2))
    risk_rank = (F.when(F.col("risk_rating") == "HIGH", 3).when(F.col("risk_rating") == "MEDIUM", 2)
                 .when(F.col("risk_rating") == "LOW", 1).otherwise(0))
    g = (deduped.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *[_first_non_null(c) for c in CUSTOMER_ATTRS],
        F.max(kyc_rank).alias("kyc_rank"),
        F.max(F.when(F.col("pep_flag"), 1).otherwise(0)).cast("boolean").alias("ever_pep"),
        F.max(F.when(F.col("sanctions_hit"), 1).otherwise(0)).cast("boolean").alias("ever_sanctioned"),
        F.max(risk_rank).alias("risk_rank"),
        F.count(F.lit(1)).alias("txn_count")))
    g = keys.dense_key(g, [F.col("customer_id").asc()], "customer_key")
    return g.select("customer_key", "customer_id", *CUSTOMER_ATTRS, "kyc_rank", "ever_pep",
                    "ever_sanctioned", "risk_rank", "txn_count")


def dim_merchant(deduped: DataFrame) -> DataFrame:
    g = (deduped.filter(F.col("merchant_id").isNotNull()).groupBy("merchant_id").agg(
        _first_non_null("merchant_name"), _first_non_null("merchant_mcc"),
        _first_non_null("merchant_country"), F.count(F.lit(1)).alias("txn_count")))
    g = keys.dense_key(g, [F.col("merchant_id").asc()], "merchant_key")
    return g.select("merchant_key", "merchant_id", "merchant_name", "merchant_mcc",
                    "merchant_country", "txn_count",
                    F.coalesce(F.col("merchant_mcc").isin(*rules.HIGH_RISK_MCC), F.lit(False))
                    .alias("is_high_risk_mcc"))


def dim_channel(deduped: DataFrame) -> DataFrame:
    """Distinct (channel, entry_mode) pairs with at least one side known."""
    d = (deduped.filter(F.col("channel").isNotNull() | F.col("entry_mode").isNotNull())
         .select("channel", "entry_mode").distinct())
    d = keys.dense_key(d, [F.col("channel").asc_nulls_last(), F.col("entry_mode").asc_nulls_last()],
                       "channel_key")
    return d.select("channel_key", "channel", "entry_mode",
                    F.coalesce(F.col("entry_mode").isin(*rules.CNP_ENTRY_MODES), F.lit(False))
                    .alias("is_card_not_present"))


def dim_card(deduped: DataFrame) -> DataFrame:
    d = (deduped.filter(F.col("card_bin").isNotNull() | F.col("card_brand").isNotNull())
         .select("card_bin", "card_brand").distinct())
    d = keys.dense_key(d, [F.col("card_bin").asc_nulls_last(), F.col("card_brand").asc_nulls_last()],
                       "card_key")
    return d.select("card_key", "card_bin", "card_brand")


def dim_risk_rule(spark, rule_set=rules.RULES) -> DataFrame:
    return rules.rule_table(spark, rule_set)


# ------------------------------------------------------------ unknown members

def _unknown_row(df: DataFrame, values: dict) -> DataFrame:
    spark = df.sparkSession
    cols = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.unionByName(spark.range(1).select(*cols))


# The members that stand for what is not known.
UNKNOWN_MEMBERS = {
    "dim_customer": {"customer_key": UNKNOWN_KEY, "customer_id": "UNKNOWN", "kyc_rank": 1,
                     "ever_pep": False, "ever_sanctioned": False, "risk_rank": 0, "txn_count": 0},
    "dim_merchant": {"merchant_key": UNKNOWN_KEY, "merchant_id": "UNKNOWN",
                     "merchant_name": "Unknown merchant", "txn_count": 0, "is_high_risk_mcc": False},
    "dim_channel": {"channel_key": UNKNOWN_KEY, "channel": "UNKNOWN", "entry_mode": "UNKNOWN",
                    "is_card_not_present": False},
    "dim_card": {"card_key": UNKNOWN_KEY, "card_bin": "UNKNOWN", "card_brand": "UNKNOWN"},
    "dim_date": {"date_key": UNKNOWN_KEY, "month_name": "Unknown", "day_name": "Unknown",
                 "is_weekend": False},
    "dim_time": {"time_key": UNKNOWN_KEY, "hour_of_day": -1, "hour_label": "Unknown",
                 "day_part": "Unknown", "is_odd_hour": False},
}


def with_unknown(name: str, df: DataFrame) -> DataFrame:
    """Append the Unknown member (key -1) of dimension ``name``."""
    return _unknown_row(df, UNKNOWN_MEMBERS[name])


# ---------------------------------------------------------------------- facts

# The fact's columns.
FACT_COLUMNS = ["_mirror_row_id", "txn_id", "date_key", "time_key", "customer_key", "merchant_key",
                "channel_key", "card_key", "txn_ts", "txn_type", "txn_status", "txn_amount",
                "txn_currency", "amount_local", "fee_amount", "auth_approved", "risk_score",
                "rules_fired", "risk_band"]


NULL_SPREAD = 1024


def _spread_nulls(col: str) -> Column:
    salt = F.pmod(F.xxhash64(F.col(_ID)), F.lit(NULL_SPREAD)).cast("string")
    return F.coalesce(F.col(col), F.concat(F.lit("\u0001null-"), salt))


def fact_transaction(deduped: DataFrame, dims: dict) -> DataFrame:
    """Resolve six foreign keys by left joins; a miss is the Unknown key.

    Dimensions are joined without their Unknown member. Date, time and rule
    dimensions are bounded by construction (days observed, 24 hours) and are
    broadcast; the others are left to AQE, which broadcasts them when their
    measured size is under the threshold and otherwise keeps a shuffle join
    (splitting a skewed partition, e.g. the NULL-key rows)."""
    d = deduped.withColumn("__date", F.to_date("txn_ts")).withColumn("__hour", F.hour("txn_ts"))
    dd = dims["dim_date"].filter(F.col("date_key") != UNKNOWN_KEY).select(
        F.col("date_key"), F.col("full_date").alias("__date"))
    dt = dims["dim_time"].filter(F.col("time_key") != UNKNOWN_KEY).select(
        F.col("time_key"), F.col("hour_of_day").alias("__hour"))
    dc = dims["dim_customer"].filter(F.col("customer_key") != UNKNOWN_KEY).select(
        "customer_key", "customer_id")
    dm = dims["dim_merchant"].filter(F.col("merchant_key") != UNKNOWN_KEY).select(
        "merchant_key", "merchant_id")
    ch = dims["dim_channel"].filter(F.col("channel_key") != UNKNOWN_KEY).select(
        "channel_key", F.col("channel").alias("__ch"), F.col("entry_mode").alias("__em"))
    cd = dims["dim_card"].filter(F.col("card_key") != UNKNOWN_KEY).select(
        "card_key", F.col("card_bin").alias("__bin"), F.col("card_brand").alias("__brand"))
    # A NULL id never matches, but as a join key every NULL row would hash
    # to one partition. Spread them over NULL_SPREAD salted values that no
    # dimension key can equal (they start with a control character).
    d = (d.withColumn("__cust", _spread_nulls("customer_id"))
         .withColumn("__merch", _spread_nulls("merchant_id")))
    j = (d.join(F.broadcast(dd), "__date", "left")
         .join(F.broadcast(dt), "__hour", "left")
         .join(dc.withColumnRenamed("customer_id", "__cust"), "__cust", "left")
         .join(dm.withColumnRenamed("merchant_id", "__merch"), "__merch", "left"))
    j = j.join(ch, j["channel"].eqNullSafe(ch["__ch"]) & j["entry_mode"].eqNullSafe(ch["__em"]), "left")
    j = j.join(cd, j["card_bin"].eqNullSafe(cd["__bin"]) & j["card_brand"].eqNullSafe(cd["__brand"]), "left")
    fk = {k: F.coalesce(F.col(k), F.lit(UNKNOWN_KEY)).cast("long")
          for k in ("date_key", "time_key", "customer_key", "merchant_key", "channel_key", "card_key")}
    return j.withColumns(fk).withColumn("risk_band", rules.band()).select(*FACT_COLUMNS)


def fact_alert(deduped: DataFrame, rule_set=rules.RULES) -> DataFrame:
    """Unpivot the flags to one row per firing in a single scan."""
    arr = F.array(*[F.struct(F.col(r.name).alias("fired"), F.lit(r.rule_id).alias("rule_id"),
                             F.lit(r.weight).alias("weight")) for r in rule_set])
    fired = F.filter(arr, lambda x: x["fired"])
    return (deduped.select(_ID, F.explode(fired).alias("__a"))
            .select(_ID, F.col("__a.rule_id").alias("rule_id"), F.col("__a.weight").alias("weight")))


# ------------------------------------------------------------------ the star

DIMENSIONS = ("dim_date", "dim_time", "dim_customer", "dim_merchant", "dim_channel", "dim_card",
              "dim_risk_rule")


def dimensions(deduped: DataFrame, with_unknown_members: bool = True) -> dict:
    spark = deduped.sparkSession
    dims = {
        "dim_date": dim_date(deduped),
        "dim_time": dim_time(spark),
        "dim_customer": dim_customer(deduped),
        "dim_merchant": dim_merchant(deduped),
        "dim_channel": dim_channel(deduped),
        "dim_card": dim_card(deduped),
        "dim_risk_rule": dim_risk_rule(spark),
    }
    if with_unknown_members:
        for name in UNKNOWN_MEMBERS:
            dims[name] = with_unknown(name, dims[name])
    return dims
