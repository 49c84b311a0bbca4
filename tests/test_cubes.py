"""Stored cubes, one-scan measures, one-pass orphans, publications of several tables, kept runs."""
import pytest
from pyspark.sql import functions as F

from vigil.operators import cubes, metrics
from vigil.operators import quality as Q
from vigil.plans import q_recon
from vigil.sources import sinks


def _scans(df, table):
    """How often the plan reads a stage's folder."""
    name = table.inputFiles()[0].rsplit("/", 2)[1]
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [_mirror_row_id"), name


def test_all_cubes_from_one_scan(cat):
    df = cubes.build(cat.star(), q_recon.CUBES, q_recon.STORED)
    assert _scans(df, cat.table("fact_transaction"))[0] == 1
    whole = cat.table("fact_transaction").count()
    assert {r.cube: r.n for r in df.groupBy("cube").agg(F.sum("transactions").alias("n")).collect()} == dict.fromkeys(q_recon.CUBES, whole)


def test_roll_up_reads_no_fact_and_refuses_what_does_not_add_up(cat):
    stored = cat.materialize(cubes.build(cat.star(), {"o": q_recon.CUBES["overview"]}, q_recon.STORED), "o")
    up = cubes.roll_up(stored, ["fact_transaction.risk_band"], q_recon.STORED)
    assert "_mirror_row_id" not in up._jdf.queryExecution().optimizedPlan().toString()
    want = {r.risk_band: r for r in metrics.evaluate(cat.star(), q_recon.STORED, ["fact_transaction.risk_band"]).collect()}
    for r in up.collect():
        assert (r.transactions, r.total_amount) == (want[r.risk_band].transactions, want[r.risk_band].total_amount) and r.avg_risk_score == pytest.approx(want[r.risk_band].avg_risk_score)
    for by, ms in ((["dim_card.card_brand"], ["transactions"]), (["fact_transaction.risk_band"], ["distinct_customers"]), (["fact_transaction.risk_band"], ["rule_firings"]),
                   (["fact_transaction.risk_band"], ["high_risk_txns"])):
        with pytest.raises(cubes.NotAdditive):
            cubes.roll_up(stored, by, ms)
    with pytest.raises(cubes.NotAdditive):
        cubes.build(cat.star(), {"o": ["fact_transaction.risk_band"]}, ["distinct_customers"])


def test_sketches_estimate_distinct_counts(cat):
    stored = cubes.build(cat.star(), {"o": q_recon.CUBES["overview"]}, ["transactions", "distinct_customers"], sketches=True)
    up = cubes.roll_up(stored, ["fact_transaction.risk_band"], ["transactions", "distinct_customers"], sketches=True).collect()
    want = {r.risk_band: r.distinct_customers for r in metrics.evaluate(cat.star(), ["distinct_customers"], ["fact_transaction.risk_band"]).collect()}
    assert all(r.distinct_customers_estimate == pytest.approx(want[r.risk_band], rel=0.05) for r in up)


def test_measures_take_one_scan_a_table(cat):
    ms = ["transactions", "high_risk_txns", "exposure_at_risk", "approval_rate", "cross_border_amount", "analyst_years"]
    df = metrics.evaluate(cat.star(), ms, ["fact_transaction.txn_type"])
    assert _scans(df, cat.table("fact_transaction"))[0] == 1
    both = metrics.evaluate(cat.star(), [*ms, "firings_per_alert"], ["fact_transaction.risk_band"])
    assert both._jdf.queryExecution().optimizedPlan().toString().count("Window [") >= 1


def test_cents(cat):
    ms = ["transactions", "total_amount", "exposure_at_risk"]
    a, b = (metrics.evaluate(cat.star(), ms, ["dim_channel.channel"], cents=x).collect() for x in (False, True))
    assert sorted((r.channel or "", int(r.total_amount * 100), r.transactions) for r in a) == sorted((r.channel or "", r.total_amount, r.transactions) for r in b)
    assert dict(metrics.evaluate(cat.star(), ms, cents=True).dtypes)["total_amount"] == "bigint"


def test_orphans_in_one_scan(cat):
    df = Q.orphans(q_recon._orphaned(cat.table("fact_transaction")), cat.dims(), q_recon.FK_DIMS)
    assert _scans(df, cat.table("fact_transaction"))[0] == 1
    assert all(r.orphan_rows > 0 and r.orphan_keys > 0 for r in df.collect())


def test_a_set_is_armed_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "set")
    nine = {f"t{i}": spark.range(i + 1).toDF("k") for i in range(9)}
    with pytest.raises(RuntimeError, match="not armed"):
        sinks.read_set(spark, path)
    assert sinks.publish_set(nine, path, {"t0": ["k"]}) == 0
    broken = nine | {"t0": spark.range(50).toDF("k"), "t7": spark.range(5).select(F.raise_error(F.lit("lost")).alias("k"))}
    with pytest.raises(Exception, match="lost"):
        sinks.publish_set(broken, path)
    assert {n: df.count() for n, df in sinks.read_set(spark, path).items()} == {f"t{i}": i + 1 for i in range(9)}
    assert sinks.publish_set(nine | {"t0": spark.range(50).toDF("k")}, path) == 1
    assert sinks.read_set(spark, path)["t0"].count() == 50 and sinks.read_set(spark, path, 0)["t0"].count() == 1


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    sinks.publish_set({"t": spark.range(3).toDF("k")}, path)
    monkeypatch.setattr(sinks, "_versions", lambda *a: [])  # a writer that looked before the other was done
    with pytest.raises(RuntimeError, match="another writer"):
        sinks.publish_set({"t": spark.range(9).toDF("k")}, path)
    monkeypatch.undo()
    assert sinks.read_set(spark, path)["t"].count() == 3


def test_runs_are_kept_and_compared(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, rows in ((1, [("a", 1), ("b", 2)]), (2, [("a", 1), ("b", 5)]), (3, [("a", 1), ("c", 7)])):
        Q.record_run(spark.createDataFrame(rows, "metric string, value long"), path, run)
    with pytest.raises(Exception, match="(?i)exists"):
        Q.record_run(spark.createDataFrame([("a", 9)], "metric string, value long"), path, 2)
    got = {(r.run, r.metric): (r.value, r.previous, r.moved) for r in Q.compare_runs(spark, path).collect()}
    assert got == {(2, "a"): (1, 1, False), (2, "b"): (5, 2, True), (2, "c"): (0, 0, False), (3, "a"): (1, 1, False), (3, "b"): (0, 5, True), (3, "c"): (7, 0, True)}
