"""Change lines: decoding, quarantine, keys, order across batches, compaction and apply."""
import datetime as dt

import pyspark.sql.types as T
import pytest
from pyspark.sql import functions as F

from vigil.streaming import cdc, mirror, stream

TARGET = "k long, v string, ok boolean"


def _decode(spark, payloads, op="UPDATE"):
    rows = [(i, f"table shop.item: {op}: {p}") for i, p in enumerate(payloads)]
    return cdc.decode(spark.createDataFrame(rows, "seq long, value string")).orderBy("seq", "part").collect()


def test_values(spark):
    got = _decode(spark, [
        "n[integer]:-7 s[text]:'two words' z[text]:null",
        "s[text]:'' t[character varying(10)]:'it''s' l[integer[]]:'{1,2}'",
        "s[text]:'k[bigint]:5 new-tuple: q' b[boolean]:t",
        "s[text]:'first\nsecond' \"Strange \"\"Name\"\"\"[text]:'ü'",
    ])
    assert [dict(r.fields) for r in got] == [
        {"n": "-7", "s": "two words", "z": None}, {"s": "", "t": "it's", "l": "{1,2}"},
        {"s": "k[bigint]:5 new-tuple: q", "b": "t"}, {"s": "first\nsecond", 'Strange "Name"': "ü"}]
    assert {(r.schema_name, r.table_name, r.op, r[cdc.ROW_MARKER]) for r in got} == {("shop", "item", "UPDATE", "1")}


def test_key_change_and_unchanged(spark):
    got = _decode(spark, ["old-key: k[bigint]:1 new-tuple: k[bigint]:2 v[text]:'x'", "k[bigint]:3 v[text]:unchanged-toast-datum"])
    assert [(r.op, dict(r.fields), r[cdc.UNCHANGED_COL]) for r in got] == [
        ("DELETE", {"k": "1"}, []), ("UPDATE", {"k": "2", "v": "x"}, []), ("UPDATE", {"k": "3"}, ["v"])]


def test_quarantine_reasons(spark):
    lines = [("BEGIN 9",), ("COMMIT 9",), ("what is this",), ("table a.b: DELETE: (no-tuple-data)",), ("table a.b: DELETE:",),
             ("table a.b: INSERT: k[bigint]:1 v[text]:'open",), ("table a.b: INSERT: k[bigint]:1 k[bigint]:2",),
             ("table a.b: INSERT: k[bigint]:1\nstray",), ("BEGIN 1\nlost",), ("",)]
    df = spark.createDataFrame(lines, "value string")
    got = sorted((r.value, r.reason) for r in cdc.quarantine(df).collect())
    assert got == sorted([("what is this", "not a change"), (lines[3][0], "no tuple"), (lines[4][0], "no tuple"), (lines[5][0], "payload not understood"),
                          (lines[6][0], "repeated column"), ("stray", "not a change"), ("lost", "not a change")])
    assert [dict(r.fields) for r in cdc.decode(df).collect()] == [{"k": "1"}]


def _typed(spark, lines):
    schema = spark.createDataFrame([], TARGET).schema
    rows = [(i, x) for i, x in enumerate(lines)]
    return cdc.coerce(cdc.decode(spark.createDataFrame(rows, "seq long, value string")), schema, "s", "t", keep=("seq",), unchanged=True), schema


def test_compact_and_apply(spark):
    typed, schema = _typed(spark, [
        "table s.t: INSERT: k[bigint]:1 v[text]:'a' ok[boolean]:t", "table s.t: UPDATE: k[bigint]:1 v[text]:unchanged-toast-datum ok[boolean]:f",
        "table s.t: INSERT: k[bigint]:2 v[text]:'c' ok[boolean]:x", "table s.t: DELETE: k[bigint]:2", "table s.t: DELETE: k[bigint]:9",
        "table s.t: UPDATE: k[bigint]:bad v[text]:'z'", "table s.t: UPDATE: k[bigint]:7 v[text]:unchanged-toast-datum ok[boolean]:t", "table s.u: DELETE: k[bigint]:7"])
    assert [r.v for r in cdc.bad_keys(typed, "k").collect()] == ["z"]
    snap = spark.createDataFrame([(9, "old", True), (7, "keep", None), (None, "no key", True)], schema)
    comp = cdc.compact(typed, "k")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    once = rows(cdc.apply(snap, comp, "k"))
    assert once == sorted([(1, "a", False), (7, "keep", True), (None, "no key", True)], key=str)
    assert rows(cdc.apply(cdc.apply(snap, comp, "k"), comp, "k")) == once  # a replay changes nothing
    view = rows(cdc.current_view(snap.filter("k is not null"), typed, "k").select("k", "v", "ok"))
    assert view == sorted([(1, "a", False), (7, "keep", True)], key=str)


def test_many_files_over_two_batches(spark, tmp_path):
    """More files in the first batch than any packed number allowed: the later batch still wins."""
    land, out = tmp_path / "land", str(tmp_path / "mirror")
    land.mkdir()
    schema = spark.createDataFrame([], TARGET).schema

    def run():
        stream.run_stream(spark, str(land), out, str(tmp_path / "ckpt"), schema, "k", "s", "t").awaitTermination()

    for i in range(1200):
        (land / f"a{i:05d}.txt").write_text(f"table s.t: UPDATE: k[bigint]:{i % 3} v[text]:'a{i}'\n")
    run()
    (land / "b.txt").write_text("table s.t: UPDATE: k[bigint]:0 v[text]:'line\ntable'\njunk\ntable s.t: UPDATE: old-key: k[bigint]:1 new-tuple: k[bigint]:5 v[text]:'five'\ntable s.t: DELETE: (no-tuple-data)\ntable s.t: UPDATE: k[bigint]:? v[text]:'q'\n")
    run()
    seed = spark.createDataFrame([], schema)
    got = sorted((r.k, r.v) for r in stream.current(spark, seed, out, schema, "k").collect())
    assert got == [(0, "line\ntable"), (2, "a1199"), (5, "five")]
    lost = stream.quarantine(spark, out).collect()
    assert sorted(r.reason for r in lost) == ["no key", "no tuple", "not a change"]
    top = stream.high_water(spark, out, schema).first()
    assert top["last"].batch == 1 and top.batches == 2


def _mirror(spark, tmp_path, rows=400, buckets=8):
    schema = spark.createDataFrame([], TARGET).schema
    seed = spark.createDataFrame([(i, f"s{i}", True) for i in range(rows)], schema)
    base = str(tmp_path / "mirror")
    mirror.seed_version(seed, base, "k", buckets)
    return base, schema, seed


def _batch(spark, base, schema, n, lines, buckets=8, files=("f",), numbered=False):
    rows = [(n, f"{f}.txt", dt.datetime(2024, 1, 1) + dt.timedelta(days=n), i, x) for f in files for i, x in enumerate(lines)]
    read = spark.createDataFrame(rows, "batch long, file string, landed_at timestamp, pos int, value string")
    return stream.commit_parsed(spark, base, n, cdc.parse(read), read.columns, schema, "k", "s", "t", buckets, numbered)


def _rows(df):
    return {r.k: r.v for r in df.collect()}


def test_batches_have_no_gap_and_no_overlap(spark, tmp_path):
    base, schema, _ = _mirror(spark, tmp_path)
    put = lambda n, v: _batch(spark, base, schema, n, [f"table s.t: UPDATE: k[bigint]:1 v[text]:'{v}'"])
    assert put(0, "a") == "committed" and put(0, "a") == "replayed"
    for bad in ((2, "c"), (0, "other")):
        with pytest.raises(mirror.LedgerError):
            put(*bad)
    assert put(1, "b") == "committed" and _rows(stream.current(spark, None, base, schema, "k"))[1] == "b"
    assert [r["batch"] for r in mirror.ledger(spark, base)] == [0, 1]
    assert _rows(mirror.current(spark, base, schema, "k", stream.ORDER, upto=0))[1] == "a"


def test_file_numbers_have_no_gap(spark, tmp_path):
    base, schema, _ = _mirror(spark, tmp_path)
    line = ["table s.t: DELETE: k[bigint]:1"]
    _batch(spark, base, schema, 0, line, files=("00000000000000000000", "00000000000000000001"), numbered=True)
    with pytest.raises(mirror.LedgerError):
        _batch(spark, base, schema, 1, line, files=("00000000000000000003",), numbered=True)
    land = tmp_path / "land"
    land.mkdir()
    for n in (0, 1, 2, 4):
        (land / f"{n:020d}.txt").write_text(line[0])
    with pytest.raises(mirror.LedgerError, match=r"\[3\]"):
        mirror.check_landing(spark, base, str(land))
    (land / f"{3:020d}.txt").write_text(line[0])
    assert mirror.check_landing(spark, base, str(land)) == [2, 3, 4]


def test_torn_batch_is_invisible(spark, tmp_path, monkeypatch):
    base, schema, _ = _mirror(spark, tmp_path)
    line = ["table s.t: UPDATE: k[bigint]:5 v[text]:'new'", "junk"]
    monkeypatch.setattr(cdc, "batch_stats", lambda df: df.select(F.raise_error(F.lit("torn")).alias("inserts")))
    with pytest.raises(Exception, match="torn"):
        _batch(spark, base, schema, 0, line)
    assert stream.changes(spark, base, schema).count() == 0 and stream.quarantine(spark, base).count() == 0
    assert _rows(stream.current(spark, None, base, schema, "k"))[5] == "s5"
    monkeypatch.undo()
    assert _batch(spark, base, schema, 0, line) == "committed"
    assert stream.changes(spark, base, schema).count() == stream.quarantine(spark, base).count() == stream.stats(spark, base).count() == 1


def test_compaction_rewrites_only_touched_buckets(spark, tmp_path, monkeypatch):
    base, schema, seed = _mirror(spark, tmp_path)
    _batch(spark, base, schema, 0, ["table s.t: UPDATE: k[bigint]:7 v[text]:'x'", "table s.t: DELETE: k[bigint]:8", "table s.t: INSERT: k[bigint]:900 v[text]:'n'"])
    first = mirror.versions(spark, base)[-1]
    before = stream.current(spark, None, base, schema, "k")
    want = _rows(seed) | {7: "x", 900: "n"}
    want.pop(8)
    assert _rows(before) == want
    with monkeypatch.context() as m:  # a compaction that fails before its version is armed disturbs nobody
        m.setattr(mirror, "_arm", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            mirror.compact(spark, base, schema, "k", stream.ORDER)
    assert mirror.versions(spark, base)[-1] == first and _rows(before) == want
    second = mirror.compact(spark, base, schema, "k", stream.ORDER)
    touched = {b for b in range(8) if first.folders.get(b) != second.folders.get(b)}
    assert 1 <= len(touched) <= 3 and touched == set(mirror.ledger(spark, base)[0]["buckets"]) and second.through == 0
    assert _rows(before) == want == _rows(stream.current(spark, None, base, schema, "k"))  # a reader of the old version goes on
    assert mirror.compact(spark, base, schema, "k", stream.ORDER) == second  # nothing new
    _batch(spark, base, schema, 1, [f"table s.t: DELETE: k[bigint]:{i}" for i in range(400)] + ["table s.t: DELETE: k[bigint]:900"])
    assert mirror.compact(spark, base, schema, "k", stream.ORDER).folders == {} and stream.current(spark, None, base, schema, "k").count() == 0


def test_retention(spark, tmp_path):
    base, schema, _ = _mirror(spark, tmp_path)
    for n in range(12):
        _batch(spark, base, schema, n, [f"table s.t: UPDATE: k[bigint]:{n} v[text]:'v{n}'"])
    assert stream.history(spark, base, schema).count() == 8
    assert mirror.expire(spark, base) == -1  # not folded into a version yet
    want = _rows(stream.current(spark, None, base, schema, "k"))
    mirror.compact(spark, base, schema, "k", stream.ORDER)
    assert mirror.expire(spark, base) == 3
    assert stream.changes(spark, base, schema).count() == 8 and _rows(stream.current(spark, None, base, schema, "k")) == want
    with pytest.raises(mirror.LedgerError):
        mirror.current(spark, base, schema, "k", stream.ORDER, upto=2)


def test_validity_of_a_hot_key(spark):
    rows = [(1, i, "1") for i in range(500)] + [(None, i, "1") for i in range(20)] + [(k, 3 * k, "2") for k in range(2, 40)]
    feed = spark.createDataFrame(rows, f"k long, seq long, {cdc.ROW_MARKER} string")
    got = {(r.k, r.valid_from): r.valid_to for r in mirror.validity(feed, "k").collect()}
    assert got == {(k, s): s + 1 if (k, s + 1) in {(a, b) for a, b, _ in rows} and k in (1, None) else None for k, s, _ in rows}


def test_each_record_is_matched_once(spark):
    df = spark.createDataFrame([(1, "x")], "seq long, value string")
    plan = cdc.decode(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("regexp_extract(") == 4 and "regexp_replace" not in plan and "RLIKE" not in plan


def test_a_feed_without_batches_is_empty_and_a_broken_one_an_error(spark, tmp_path):
    schema = spark.createDataFrame([], TARGET).schema
    assert stream.changes(spark, str(tmp_path / "none"), schema).count() == 0
    base, schema, _ = _mirror(spark, tmp_path)
    _batch(spark, base, schema, 0, ["table s.t: DELETE: k[bigint]:1"])
    folder = tmp_path / "mirror" / mirror.ledger(spark, base)[0]["folder"] / "changes"
    for f in folder.glob("*.parquet"):
        f.write_text("not parquet")
    for f in folder.glob(".*.crc"):
        f.unlink()
    with pytest.raises(Exception):  # noqa: B017
        stream.changes(spark, base, schema).collect()


def test_schema_preflight(spark):
    exp = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    bad = T.StructType([T.StructField("v", T.StringType()), T.StructField("k", T.StringType()),
                        T.StructField("x", T.StringType()), T.StructField(cdc.ROW_MARKER, T.StringType())])
    issues = {r["issue"] for r in cdc.check_schema(exp, bad, spark).collect()}
    assert issues == {"extra", "type", "order"}


def test_history_keeps_retention_window(spark):
    base = dt.datetime(2024, 1, 31)
    rows = [(i, base - dt.timedelta(days=d)) for i, d in enumerate([0, 3, 7, 8, 30])]
    feed = spark.createDataFrame(rows, "k long, ts timestamp")
    kept = sorted(r["k"] for r in cdc.history(feed, "ts", retain_days=7).collect())
    assert kept == [0, 1, 2]


def test_a_batch_is_parsed_once_and_a_refused_one_never(spark, tmp_path, monkeypatch):
    base, schema, _ = _mirror(spark, tmp_path)
    seen, parse = [], cdc.parse
    monkeypatch.setattr(cdc, "parse", lambda *a: seen.append(1) or parse(*a))

    def put(n, v):
        rows = [(n, "f.txt", dt.datetime(2024, 1, 1), 0, f"table s.t: UPDATE: k[bigint]:1 v[text]:'{v}'")]
        read = spark.createDataFrame(rows, "batch long, file string, landed_at timestamp, pos int, value string")
        return stream.commit_lines(spark, base, n, read, schema, "k", "s", "t", 8)

    assert put(0, "a") == "committed" and len(seen) == 1
    assert put(0, "a") == "replayed"
    for bad in ((2, "c"), (0, "other")):
        with pytest.raises(mirror.LedgerError):
            put(*bad)
    assert len(seen) == 1 and put(1, "b") == "committed" and _rows(stream.current(spark, None, base, schema, "k"))[1] == "b"


def test_the_feed_is_decoded_once(spark, cat, monkeypatch):
    from vigil.plans import q_cdc
    cat._t.pop("changes_typed", None)
    seen, decode = [], cdc.decode
    monkeypatch.setattr(cdc, "decode", lambda *a: seen.append(1) or decode(*a))
    q_cdc.q_cdc_as_of(cat).count()
    q_cdc.q_cdc_version_counts(cat).count()
    assert len(seen) == 1


def test_landing_files_are_rotated(spark, cat, monkeypatch):
    """A file is one value for the reader: none may grow with the table."""
    from vigil.plans import q_cdc
    monkeypatch.setattr(q_cdc, "FILE_RECORDS", 100)
    dirs, run = [], stream.run_stream
    monkeypatch.setattr(stream, "run_stream", lambda spark, d, *a: dirs.append(d) or run(spark, d, *a))
    rows = q_cdc.q_cdc_stream(cat).count()
    lines = q_cdc._lines(cat).count()
    per_file = spark.read.option("wholetext", True).text(dirs[0]).selectExpr("size(split(value, '\\n(?=table |BEGIN|COMMIT|garbage)')) AS n").collect()
    assert rows == q_cdc.q_cdc_apply(cat).count() and lines > 300 and max(r.n for r in per_file) <= 101
