"""Engine properties on the sf0.001 tables."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import dedup, features, keys, quality, rules, star
from vigil.plans.q_quality import mirror_off_by_two

COLS = ["_mirror_row_id", "cust_txn_count", "amt_pct_in_customer", "first_seen_merchant", "acct_txns_same_hour"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_features_equal_plain_windows(cat):
    s = cat.silver()
    plain = _rows(features.add_windows_plain(s))
    assert _rows(features.add(s)) == plain
    assert _rows(features.add(s.repartition(1), ranges=3)) == plain


def test_features_with_hot_keys_mixed_with_others(cat):
    """One customer and one amount hold 30% of the rows each, a seventh of the amounts, customers and times is NULL."""
    s = cat.silver()
    i = F.col("_mirror_row_id")
    hot = (s.withColumn("customer_id", F.when(i % 7 == 3, F.lit(None).cast("string")).when(i % 10 < 3, F.lit("HOT")).otherwise(F.col("customer_id")))
           .withColumn("txn_amount", F.when(i % 7 == 1, F.lit(None).cast("decimal(18,2)")).when((i * 3) % 10 < 3, F.lit(5).cast("decimal(18,2)")).otherwise(F.col("txn_amount")))
           .withColumn("txn_ts", F.when(i % 7 != 5, F.col("txn_ts"))))
    assert _rows(features.add(hot, ranges=4)) == _rows(features.add_windows_plain(hot))
    # No range holds more than its share of the hot customer's amounts.
    wide = s.select(i.alias("_mirror_row_id"), F.lit("HOT").alias("customer_id"), F.rand(1).cast("decimal(18,9)").alias("txn_amount"))
    sizes = features.amount_ranks(wide, 4).withColumn("p", F.floor(F.col("__less") * 4 / F.col("__n"))).groupBy("p").count().collect()
    assert len(sizes) == 4


def test_dedup_forms_agree(cat):
    sc = cat.scored()
    a = sorted(r[0] for r in dedup.keep_first(sc).select("_mirror_row_id").collect())
    b = sorted(r[0] for r in dedup.keep_first_window(sc).select("_mirror_row_id").collect())
    assert a == b


def test_dense_key_equals_row_number(cat):
    d = cat.deduped().select("customer_id").filter("customer_id IS NOT NULL").distinct()
    got = keys.dense_key(d, [F.col("customer_id").asc()], "k", partitions=5)
    want = d.withColumn("k", F.row_number().over(Window.orderBy("customer_id")))
    assert sorted(got.collect()) == sorted(want.select("customer_id", "k").collect())


def test_star_properties(cat):
    ft, fa = cat.table("fact_transaction"), cat.table("fact_alert")
    assert fa.count() == ft.agg(F.sum("rules_fired")).collect()[0][0]
    rec = quality.dedup_recon(cat.scored(), cat.deduped()).collect()[0]
    assert rec["scored_rows"] - rec["removed"] == rec["deduped_rows"]
    assert rec["ids_surviving_twice"] == 0
    fks = ["date_key", "time_key", "customer_key", "merchant_key", "channel_key", "card_key"]
    assert ft.filter(" OR ".join(f"{k} IS NULL" for k in fks)).count() == 0
    for name in star.UNKNOWN_MEMBERS:
        assert cat.table(name).filter(F.col(name.replace("dim_", "") + "_key") == -1).count() == 1


def test_score_is_sum_of_weights(cat):
    sc = cat.scored()
    w = sum(F.when(F.col(r.name), r.weight).otherwise(0) for r in rules.RULES)
    assert sc.filter(F.col("risk_score") != w).count() == 0


def test_fingerprint_diff_catches_what_counts_miss(cat):
    raw = cat.raw()
    mirror = mirror_off_by_two(raw)
    assert raw.count() == mirror.count()
    sides = {r["side"] for r in quality.fingerprint_diff(raw, mirror).collect()}
    assert sides == {"left_only", "right_only"}


def test_acceptance_all_pass(spark):
    import __spark_entry__ as E
    res = E.queries()["acceptance"](spark, "/root/testdata/sf0.001").collect()
    assert {r["status"] for r in res} == {"PASS"}


def test_build_star_checkpointed_equals_catalog(cat):
    from vigil.plans import build
    out = build.build_star(cat.raw(), materialize=True)
    for name in ("fact_transaction", "fact_alert", "dim_customer", "dim_channel"):
        a = sorted(tuple(r) for r in out[name].collect())
        b = sorted(tuple(r) for r in cat.table(name).collect())
        assert a == b, name
