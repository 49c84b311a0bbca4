"""The shared build moves narrow rows and cleans in many tasks."""
from pyspark.sql import functions as F

from vigil.plans import catalog
from vigil.sources import fixtures


def _write_events(spark, folder, n=400):
    """Rows of the events table with keys that repeat and values that are NULL."""
    i = F.col("id")
    nul = lambda e, m: F.when(i % 50 != m, e)
    (spark.range(n).select((i - i % 7 % 2).alias("event_id"), nul(F.timestamp_seconds(i * 977 + 1704067200).cast("timestamp_ntz"), 1).alias("ts"), nul(i % 9, 2).alias("user_id"),
                           F.lit("view").alias("event_type"), nul(i * 1.37, 3).alias("value"), F.lit("{}").alias("props")).write.parquet(f"{folder}/events.parquet"))


def test_events_are_dealt_out_before_they_are_made_wide(spark, tmp_path):
    _write_events(spark, str(tmp_path))
    dealt = fixtures.raw_txn(spark, str(tmp_path), 6)
    assert dealt.rdd.getNumPartitions() == 6
    assert sorted(map(str, dealt.collect())) == sorted(map(str, fixtures.raw_txn(spark, str(tmp_path)).collect()))
    # What moves is a few columns of the events, not the 45 of the landing table.
    plan = dealt._jdf.queryExecution().optimizedPlan()
    moved = []

    def walk(p):
        if p.nodeName().startswith("Repartition") and p.shuffle():
            moved.append(p.output().size())
        for k in range(p.children().size()):
            walk(p.children().apply(k))
    walk(plan)
    assert moved and max(moved) <= 4


def test_cleaning_has_more_tasks_than_cores(spark, tmp_path):
    _write_events(spark, str(tmp_path))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        c = catalog.Catalog(spark, str(tmp_path))
        assert len(c.silver().inputFiles()) >= 12  # the session has 4 cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
