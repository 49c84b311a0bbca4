"""Sources and sinks on literal rows."""
import tempfile

from vigil.sources import sinks, tables


def test_csv_keeps_null_empty_and_padding(spark):
    rows = [(1, None, "", "  padded  "), (2, 'say "hi", ok', "x,y", "'q'")]
    df = spark.createDataFrame(rows, "_mirror_row_id long, a string, b string, c string")
    path = tempfile.mkdtemp(prefix="vigil-csv-test-") + "/out"
    sinks.write_raw_csv(df, path)
    back = tables.read_raw_csv(spark, path, ["_mirror_row_id", "a", "b", "c"])
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_key_slice_and_samples(cat):
    raw = cat.raw()
    assert tables.key_slice(raw, 100).count() == raw.filter("_mirror_row_id <= 100").count()
    assert tables.sample_rows(raw, n=37).count() == 37
    a = sorted(r[0] for r in tables.sample_rows(raw, n=37).select("_mirror_row_id").collect())
    b = sorted(r[0] for r in tables.sample_rows(raw, n=37).select("_mirror_row_id").collect())
    assert a == b


def test_failed_publish_leaves_the_last_version(spark, tmp_path):
    from pyspark.sql import functions as F

    from vigil.sources import sinks
    path = str(tmp_path / "table")
    assert sinks.publish(spark.range(5).toDF("k"), path, ["k"]) == 0
    try:
        sinks.publish(spark.range(9).select(F.raise_error(F.lit("broken")).alias("k")), path, ["k"])
    except Exception:  # noqa: BLE001
        pass
    else:
        raise AssertionError("the write should fail")
    assert sinks.read_published(spark, path).count() == 5
    assert sinks.publish(spark.range(7).toDF("k"), path, ["k"]) == 1
    assert sinks.read_published(spark, path).count() == 7


def test_multi_line_csv(spark, tmp_path):
    from vigil.sources import tables
    (tmp_path / "x.csv").write_text('_mirror_row_id,a\n1,"one\ntwo"\n')
    got = tables.read_raw_csv(spark, str(tmp_path), ["_mirror_row_id", "a"], multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, "one\ntwo")]


def test_no_shared_folder_off_local_mode():
    from types import SimpleNamespace

    import pytest

    from vigil import session
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: None)))


def test_ingest_lands_a_file_a_task(spark, cat, monkeypatch):
    from vigil.plans import q_io
    landed, write = [], q_io.sinks.write_raw_csv
    monkeypatch.setattr(q_io.sinks, "write_raw_csv", lambda df, path: landed.append(df) or write(df, path))
    row = q_io.q_ingest_once(cat).first()
    assert row.ingested_rows == cat.raw().count() and row.second_run_rows == 0
    assert "Exchange" not in landed[0]._jdf.queryExecution().executedPlan().toString()
