"""The velocity stream writes what a batch changes."""
from pyspark.sql import functions as F

from vigil.operators import silver
from vigil.plans import q_stream


def test_a_batch_of_the_velocity_stream_writes_only_the_hours_it_changes(spark, cat, monkeypatch, tmp_path):
    """In complete mode each batch wrote all hours again: batches times hours."""
    land, written, run = str(tmp_path / "landing"), {}, q_stream._run
    cat.raw().repartition(24).write.parquet(land)

    def seen(c, name, *args, **kw):
        written[name] = run(c, name, *args, **kw)
        return written[name]
    monkeypatch.setattr(q_stream, "_land", lambda c, name: land)
    monkeypatch.setattr(q_stream, "_run", seen)
    rows = q_stream.q_stream_velocity(cat).collect()
    s = silver.build(cat.raw())
    timed = s.filter(F.col("txn_ts").isNotNull()).count()
    out = written["stream-velocity"]
    assert out.select("batch").distinct().count() >= 6 and out.count() <= timed
    want = s.groupBy("account_no", F.date_format(F.date_trunc("hour", "txn_ts"), "yyyy-MM-dd HH:mm:ss").alias("h")).count().collect()
    assert sorted(map(str, ((r[0], r[1], r[2], r[3]) for r in rows))) == sorted(map(str, ((r[0], r[1], r[2], r[2] >= 2) for r in want)))
    assert written["untimed-velocity"].columns == ["account_no", "batch"]
