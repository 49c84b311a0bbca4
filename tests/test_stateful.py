"""Streams with state of their own: late rows, closing windows, bounded state."""
import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from vigil.streaming import stateful

T0 = dt.datetime(2024, 1, 1)


def _run(spark, tmp_path, build, batches, schema):
    """Lands each batch and runs the stream to its end; returns the rows and the state's size after each batch."""
    base, sizes = str(tmp_path), []
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(schema).parquet(f"{base}/in")
        q = build(src).writeStream.outputMode("append").option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True)
        q = q.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{base}/out/batch={i:05d}")).start()
        q.awaitTermination()
        sizes.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1])
    return spark.read.parquet(f"{base}/out").drop("batch").collect(), sizes


def _at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_an_hour_closes_once_and_late_rows_are_counted(spark, tmp_path):
    schema = "account_no string, txn_ts timestamp"
    batches = [[("a", _at(5)), ("a", _at(59)), ("b", _at(10)), (None, _at(10))], [("a", _at(30)), ("a", _at(200))], [("a", _at(20)), ("b", _at(20)), ("b", _at(21)), ("a", _at(190))], [("end", _at(10_000))], [("a", _at(3))]]
    rows, sizes = _run(spark, tmp_path, stateful.closing_velocity, batches, schema)
    got = sorted(((r.account_no or "-", int((r.window_start - T0).total_seconds() // 3600), r.acct_txns_same_hour, r.velocity, r.late) for r in rows if r.account_no != "end"), key=str)
    assert got == sorted([("-", 0, 1, False, False), ("a", 0, 3, True, False), ("b", 0, 1, False, False), ("a", 0, 1, False, True), ("b", 0, 2, True, True), ("a", 3, 2, True, False), ("a", 0, 1, False, True)], key=str)
    assert max(sizes) <= 8 and sizes[-1] <= 2


def test_first_visits(spark, tmp_path):
    schema = "_mirror_row_id long, customer_id string, merchant_id string, txn_ts timestamp"
    many = [(i, "c", f"m{i % 3}", _at(i)) for i in range(15)]
    swapped = [(100, "c", "new", _at(31)), (99, "c", "new", _at(30)), (101, "c", None, _at(30))]
    few = [(200 + i, "d", "x", _at(i)) for i in range(5)]
    late = [(300, "c", "other", _at(1)), (301, "c", "m0", _at(400))]
    more = [(400 + i, "c", "m1", _at(410 + i)) for i in range(3)]
    rows, sizes = _run(spark, tmp_path, stateful.new_merchants, [many + few, swapped, [(250, "e", "y", _at(399))], late, more, [(999, "end", "z", _at(99_999))]], schema)
    # 15 + 3 + 1 + 3 rows of c that are not late: its first visits come out when the twentieth row has passed.
    assert sorted((r.row_id, r.late) for r in rows) == [(0, False), (1, False), (2, False), (99, False), (300, True)]
    assert sizes[-1] <= 40


def test_state_grows_with_merchants_not_with_rows(spark, tmp_path):
    schema = "_mirror_row_id long, customer_id string, merchant_id string, txn_ts timestamp"
    batches = [[(1000 * b + i, f"c{i % 4}", f"m{i % 5}", _at(300 * b + i % 60)) for i in range(400)] for b in range(4)] + [[(9, "end", "z", _at(99_999))]]
    rows, sizes = _run(spark, tmp_path, stateful.new_merchants, batches, schema)
    assert len(rows) == 20 and not any(r.late for r in rows)
    assert sizes[-1] < 60


def test_the_rule_matches_the_batch_flag_on_ordered_input(spark, cat, tmp_path):
    rows = cat.silver().filter(F.col("txn_ts").isNotNull() & F.col("customer_id").isNotNull()).select("_mirror_row_id", "customer_id", "merchant_id", F.col("txn_ts").cast("timestamp").alias("txn_ts")).orderBy("txn_ts").collect()
    cut = len(rows) // 3
    schema = "_mirror_row_id long, customer_id string, merchant_id string, txn_ts timestamp"
    data = [tuple(r) for r in rows]
    end = [(-1, "end", "z", rows[-1].txn_ts + dt.timedelta(days=9))]
    got, _ = _run(spark, tmp_path, stateful.new_merchants, [data[:cut], data[cut:2 * cut], data[2 * cut:], end], schema)
    count, first = {}, {}
    for i, c, m, t in data:
        count[c] = count.get(c, 0) + 1
        if m is not None:
            first[c, m] = min(first.get((c, m), (t, i)), (t, i))
    assert sorted(r.row_id for r in got) == sorted(i for (c, _), (_, i) in first.items() if count[c] >= 20) and not any(r.late for r in got)


class _Handle:
    """State of one key, in memory; counts the timers."""

    def __init__(self):
        self.timers = []
        self.registerTimer = self.timers.append

    def getListState(self, *_):
        s = SimpleNamespace(rows=[])
        s.get, s.appendList, s.put, s.clear = lambda: list(s.rows), s.rows.extend, lambda x: s.rows.__setitem__(slice(None), x), s.rows.clear
        return s

    def getMapState(self, *_):
        s = SimpleNamespace(rows={}, looks=[])
        s.containsKey, s.updateValue = lambda k: s.looks.append(k) or k in s.rows, s.rows.__setitem__
        return s

    def getValueState(self, *_):
        s = SimpleNamespace(row=None)
        s.get, s.update = lambda: s.row, lambda v: setattr(s, "row", v)
        return s


def test_a_batch_costs_a_key_one_timer(spark):
    """With a timer for each minute or hour, each read all waiting rows again: a key's cost grew with the square of its rows."""
    at = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    visits, handle = stateful.FirstVisits(), _Handle()
    visits.init(handle)
    rows = [SimpleNamespace(at=i * 60_000, id=i, merchant=f"m{i % 3}") for i in range(100)]
    assert not list(visits.handleInputRows(("c",), rows, at(0))) and len(handle.timers) == 1
    out = list(visits.handleExpiredTimer(("c",), at(50 * 60_000), SimpleNamespace(getExpiryTimeInMs=lambda: handle.timers[0])))
    assert [r.row_id for r in out] == [0, 1, 2] and len(visits.waiting.rows) == 50 and len(handle.timers) == 2 and len(visits.merchants.looks) == 3
    counts, handle = stateful.ClosingCounts(), _Handle()
    counts.init(handle)
    rows = [SimpleNamespace(hour_ms=(i % 50) * 3_600_000, n=1) for i in range(100)]
    assert not list(counts.handleInputRows(("a",), rows, at(0))) and handle.timers == [3_600_000]
    out = list(counts.handleExpiredTimer(("a",), at(20 * 3_600_000), None))
    assert len(out) == 20 and {r.n for r in out} == {2} and len(counts.hours.rows) == 30 and handle.timers[1:] == [21 * 3_600_000]
