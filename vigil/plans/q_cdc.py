"""Registered queries: change data capture (I), batch and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from ..streaming import cdc, changefeed, mirror, stream
from . import oracle as O
from .registry import TS_COLS, o_cols, register

TS_COLS.add("o_orderdate")
KEY = "o_orderkey"
COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
M = cdc.ROW_MARKER


def _target(c) -> T.StructType:
    return c.source("orders").select(*COLS).schema


def _lines(c):
    """The table is one file: its rows are dealt to all tasks before their lines are made. The lines are written once, as a
    feed's are; all batches and queries read them."""
    n = int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    return c._get("change_lines", lambda: changefeed.change_lines(c.source("orders").repartition(n)))


def _typed(c):
    """Typed changes; ``seq`` has the part of a change of key in its last digit, as the oracle writes it."""
    return cdc.good_keys(_all_typed(c), KEY)


def _all_typed(c):
    """All changes, decoded once: readers of several moments or of sampled ranges do not decode again."""
    return c._get("changes_typed", lambda: _all(c, cdc.decode(_lines(c)).withColumn("seq", F.col("seq") * 2 + F.col("part"))))


def _all(c, decoded):
    return cdc.coerce(decoded, _target(c), "public", "orders", keep=("seq", "op"), unchanged=True)


_I, _D = changefeed.NEW_KEY, changefeed.NEW_THEN_DELETED_KEY
# The changes as the feed means them, a row each: what each class of key does (see changefeed).
_SAME = "o_custkey, 'X', o_totalprice * {m}, o_orderdate, o_orderpriority"
_NEW = "o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority"
_NONE = "NULL, NULL, NULL, NULL, NULL"
_CHANGES = [
    (0, 0, "UPDATE", "o_orderkey", "CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END, 'X', o_totalprice * 2, o_orderdate, o_orderpriority || ' ' || chr(39) || 'x' || chr(39)"),
    (1, 0, "DELETE", "o_orderkey", _NONE),
    (2, 0, "INSERT", _I, _NEW), (3, 0, "INSERT", _D, _NEW), (3, 1, "DELETE", _D, _NONE),
    (4, 0, "UPDATE", "o_orderkey", _SAME.format(m=3)), (4, 1, "UPDATE", "o_orderkey", _SAME.format(m=4)),
    (7, 1, "UPDATE", "o_orderkey", "o_custkey, 'Y', o_totalprice, o_orderdate, o_orderpriority"),
    (8, 0, "UPDATE", _I, "o_custkey, 'K', o_totalprice, o_orderdate, o_orderpriority || chr(10) || 'second line'"),
    (9, 0, "UPDATE", "o_orderkey", "o_custkey, 'T', NULL, o_orderdate, o_orderpriority"),
]
_MARK = {"INSERT": "0", "UPDATE": "1", "DELETE": "2"}
O.extra("cdc_decoded", [], " UNION ALL ".join(
    f"SELECT (o_orderkey * 10 + {p}) * 2 + 1 AS seq, '{op}' AS op, '{_MARK[op]}' AS {M}, {k} AS o_orderkey, {', '.join(f'{v} AS {n}' for v, n in zip(_v.split(', '), COLS[1:]))} FROM orders WHERE o_orderkey % 10 = {cls}"
    for cls, p, op, k, _v in _CHANGES)
    + f" UNION ALL SELECT o_orderkey * 20, 'DELETE', '2', o_orderkey, {_NONE} FROM orders WHERE o_orderkey % 10 = 8")
O.extra("cdc_final", [], f"""
SELECT {', '.join(COLS)} FROM orders WHERE o_orderkey % 10 IN (5, 6)
UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END, 'X', o_totalprice * 2, o_orderdate, o_orderpriority || ' ' || chr(39) || 'x' || chr(39) FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT {_I}, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 2
UNION ALL SELECT {', '.join(COLS)} FROM orders WHERE o_orderkey % 10 IN (2, 3)
UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice * 4, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 4
UNION ALL SELECT o_orderkey, o_custkey, 'Y', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 7
UNION ALL SELECT {_I}, o_custkey, 'K', o_totalprice, o_orderdate, o_orderpriority || chr(10) || 'second line' FROM orders WHERE o_orderkey % 10 = 8
UNION ALL SELECT o_orderkey, o_custkey, 'T', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 9""")

_DEC_COLS = ["seq", "op", M] + COLS


@register("cdc_decode", O.sql(f"SELECT {o_cols(_DEC_COLS)} FROM cdc_decoded", "cdc_decoded"))
def q_cdc_decode(c):
    return _typed(c).select(*_DEC_COLS)


@register("cdc_compact", O.sql(f"""
SELECT {o_cols(_DEC_COLS)} FROM cdc_decoded
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1""", "cdc_decoded"))
def q_cdc_compact(c):
    return cdc.compact(_typed(c), KEY, "seq").select(*_DEC_COLS)


@register("cdc_apply", O.sql(f"SELECT {o_cols(COLS)} FROM cdc_final", "cdc_final"))
def q_cdc_apply(c):
    compacted = cdc.compact(_typed(c), KEY, "seq")
    return cdc.apply(c.source("orders").select(*COLS), compacted, KEY)


@register("cdc_current", O.sql(f"SELECT {o_cols(COLS)} FROM cdc_final", "cdc_final"))
def q_cdc_current(c):
    return cdc.current_view(c.source("orders").select(*COLS), _typed(c).drop("op"), KEY)


@register("cdc_stats", O.sql(f"""
SELECT count(*) FILTER (WHERE {M} = '0') AS inserts, count(*) FILTER (WHERE {M} = '1') AS updates,
       count(*) FILTER (WHERE {M} = '2') AS deletes, count(*) FILTER (WHERE {M} = '4') AS upserts
FROM cdc_decoded""", "cdc_decoded"))
def q_cdc_stats(c):
    return cdc.batch_stats(_typed(c))


_LOST = """
SELECT o_orderkey * 10 AS seq, 'garbage line ' || o_orderkey AS value, 'not a change' AS reason FROM orders WHERE o_orderkey % 10 = 6
UNION ALL SELECT o_orderkey * 10 + 1, 'table public.orders: DELETE: (no-tuple-data)', 'no tuple' FROM orders WHERE o_orderkey % 10 = 9"""


@register("cdc_quarantine", O.sql(_LOST))
def q_cdc_quarantine(c):
    return cdc.quarantine(_lines(c)).select("seq", "value", "reason")


@register("cdc_bad_key", O.sql("SELECT o_orderkey * 10 + 2 AS seq, 'B' AS o_orderstatus, 'no key' AS reason FROM orders WHERE o_orderkey % 10 = 9"))
def q_cdc_bad_key(c):
    return cdc.bad_keys(_all(c, cdc.decode(_lines(c))), KEY).select("seq", "o_orderstatus", "reason")


@register("cdc_key_change", O.sql(f"""
SELECT o_orderkey AS old_key, {_I} AS new_key, o_orderpriority || chr(10) || 'second line' AS o_orderpriority FROM orders WHERE o_orderkey % 10 = 8"""))
def q_cdc_key_change(c):
    """Changes of key as the pair of their delete and their update."""
    pair = _all_typed(c).withColumn("at", F.floor(F.col("seq") / 2)).groupBy("at").agg(
        F.max(F.when(F.col("seq") % 2 == 0, F.col(KEY))).alias("old_key"), F.max(F.when(F.col("seq") % 2 == 1, F.col(KEY))).alias("new_key"),
        F.max("o_orderpriority").alias("o_orderpriority"))
    return pair.filter(F.col("old_key").isNotNull()).select("old_key", "new_key", "o_orderpriority")


@register("cdc_multiline", O.sql("SELECT o_orderkey, o_orderpriority || chr(10) || 'second line' AS o_orderpriority FROM orders"))
def q_cdc_multiline(c):
    """A file's text is cut into records: values with line ends stay whole, junk lines between records go."""
    o = c.source("orders").select(KEY, "o_orderpriority")
    line = F.concat(F.lit("table public.orders: INSERT: o_orderkey[bigint]:"), F.col(KEY), F.lit(" o_orderpriority[text]:'"), F.replace("o_orderpriority", F.lit("'"), F.lit("''")), F.lit("\nsecond line'"))
    text = o.groupBy(F.floor(F.col(KEY) / 16)).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(KEY), line.alias("line")))), lambda x: x["line"]), "\njunk between\n").alias("t"))
    rec = text.select(F.explode(cdc.records(F.col("t"))).alias("value"))
    return cdc.coerce(cdc.decode(rec), o.schema).select(KEY, "o_orderpriority")


_FULL = "count(*) FILTER (WHERE c IN (0, 2, 3, 7, 8)) + 2 * count(*) FILTER (WHERE c = 4)"
_SEEN_COLS = {"o_orderkey": ("bigint", f"{_FULL} + count(*) FILTER (WHERE c IN (1, 3, 8)) + 2 * count(*) FILTER (WHERE c = 9)", None),
              "o_custkey": ("bigint", f"{_FULL} + count(*) FILTER (WHERE c = 9)", "type"),
              "o_orderstatus": ("character varying", f"{_FULL} + 2 * count(*) FILTER (WHERE c = 9)", None),
              "o_totalprice": ("double precision", _FULL, None),
              "o_orderdate": ("timestamp without time zone", f"{_FULL} + count(*) FILTER (WHERE c = 9)", None),
              "o_orderpriority": ("character varying", f"{_FULL} + count(*) FILTER (WHERE c = 9)", "extra")}


@register("cdc_feed_columns", O.sql(" UNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{t}' AS declared, {k} AS changes, " + (f"'{i}'" if i else "CAST(NULL AS VARCHAR)") + " AS issue FROM (SELECT o_orderkey % 10 AS c FROM orders)"
    for n, (t, k, i) in _SEEN_COLS.items()) + " UNION ALL SELECT 'o_comment', NULL, 0, 'missing'"))
def q_cdc_feed_columns(c):
    """What the lines declare, against an expectation with a wrong type, a column too few and one too many."""
    want = {n: t for n, (t, _, i) in _SEEN_COLS.items() if i is None} | {"o_custkey": "integer", "o_comment": "text"}
    return cdc.feed_columns(cdc.decode(_lines(c)).filter("schema_name = 'public' AND table_name = 'orders'"), want)


@register("cdc_schema_check", None)
def q_cdc_schema_check(c):
    return cdc.check_schema(_target(c), _typed(c).drop("seq", "op").schema, c.spark)


FILE_RECORDS = 20_000


@register("cdc_stream", O.sql(f"SELECT {o_cols(COLS)} FROM cdc_final", "cdc_final"))
def q_cdc_stream(c):
    """Land the change lines as ordered text files, run the stream
    once (availableNow), twice -- the second run must read nothing -- and
    read the mirror through the merge-on-read view. The writer rotates its
    files: a file is one value for the reader."""
    spark = c.spark
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/vigil-cdc-{uuid.uuid4().hex[:12]}"
    n = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (_lines(c).repartitionByRange(n, "seq").sortWithinPartitions("seq").select("value")
     .write.mode("overwrite").option("maxRecordsPerFile", FILE_RECORDS).text(f"{base}/landing"))
    target = _target(c)
    for _ in range(2):
        q = stream.run_stream(spark, f"{base}/landing", f"{base}/mirror", f"{base}/checkpoint", target, KEY,
                              "public", "orders")
        q.awaitTermination()
    return stream.current(spark, c.source("orders").select(*COLS), f"{base}/mirror", target, KEY)


_ROW = ", ".join(COLS[1:])


@register("cdc_verify", O.sql(f"""
SELECT CASE WHEN a.k IS NULL THEN 'inserted' WHEN b.k IS NULL THEN 'deleted' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'same' ELSE 'changed' END AS status, count(*) AS rows
FROM (SELECT o_orderkey AS k, row({_ROW}) AS v FROM orders) a FULL JOIN (SELECT o_orderkey AS k, row({_ROW}) AS v FROM cdc_final) b ON a.k = b.k GROUP BY 1""", "cdc_final"))
def q_cdc_verify(c):
    """What the change feed did to the mirror, by key."""
    before = c.source("orders").select(*COLS)
    return cdc.verify(before, cdc.current_view(before, _typed(c).drop("op"), KEY), KEY)


# --- the mirror: ledger, versions of buckets, history ---

BUCKETS = 16


def _base(spark, name):
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/vigil-{name}-{uuid.uuid4().hex[:12]}"


def _batch_of(c, n, lines=None):
    """The ``n``-th lines of all keys as the records of a batch."""
    at = F.col("seq") % 10
    df = (_lines(c) if lines is None else lines).filter(at == n)
    return df.select(F.lit(n).cast("long").alias("batch"), F.lit(f"{n:020d}.txt").alias("file"), F.timestamp_millis(F.lit(1_700_000_000_000 + n * 86_400_000)).alias("landed_at"),
                     (F.col("seq") / 10).cast("int").alias("pos"), "value")


def _commit(c, base, n, read=None):
    read = _batch_of(c, n) if read is None else read
    return stream.commit_lines(c.spark, base, n, read, _target(c), KEY, "public", "orders", BUCKETS)


def _seeded(c, name):
    base = _base(c.spark, name)
    mirror.seed_version(c.source("orders").select(*COLS), base, KEY, BUCKETS)
    return base


@register("cdc_compact_buckets", O.sql(f"SELECT {o_cols(COLS)} FROM cdc_final", "cdc_final"))
def q_cdc_compact_buckets(c):
    """Two batches are folded into versions of buckets, the third is read on top of the last version."""
    base = _seeded(c, "buckets")
    for n in (0, 1):
        _commit(c, base, n)
        mirror.compact(c.spark, base, _target(c), KEY, stream.ORDER)
    _commit(c, base, 2)
    return mirror.current(c.spark, base, _target(c), KEY, stream.ORDER)


# What the feed's n-th lines do: (class, batch, marker) of each change that is applied.
_APPLIED = "(VALUES (0, 0, 1), (1, 0, 2), (2, 0, 0), (3, 0, 0), (4, 0, 1), (8, 0, 2), (8, 0, 1), (9, 0, 1), (3, 1, 2), (4, 1, 1), (7, 1, 1)) AS a(class, batch, marker)"
_PER_BATCH = f"SELECT a.batch, a.marker FROM orders JOIN {_APPLIED} ON o_orderkey % 10 = a.class"


@register("cdc_batch_gap", O.sql(f"""
WITH n AS (SELECT count(*) FILTER (WHERE batch = 0) AS zero, count(*) FILTER (WHERE batch <= 1) AS one FROM ({_PER_BATCH}))
SELECT v.* FROM n, LATERAL (VALUES (1, 0, 'committed', zero), (2, 2, 'gap', zero), (3, 0, 'replayed', zero), (4, 0, 'overlap', zero), (5, 1, 'committed', one), (6, 2, 'committed', one)) AS v(attempt, batch, outcome, changes)"""))
def q_cdc_batch_gap(c):
    """What becomes of batches that come in order, too early, again, and again with other lines; and how many
    changes a reader sees after each."""
    spark, base = c.spark, _base(c.spark, "gap")
    other = _batch_of(c, 0).withColumn("value", F.concat("value", F.lit(" ")))
    out = None
    for attempt, (n, read) in enumerate([(0, None), (2, None), (0, None), (0, other), (1, None), (2, None)], 1):
        try:
            outcome = _commit(c, base, n, read)
        except mirror.LedgerError as e:
            outcome = "gap" if "gap" in str(e) else "overlap"
        seen = stream.changes(spark, base, _target(c)).agg(F.count("*").alias("changes"))
        row = seen.select(F.lit(attempt).alias("attempt"), F.lit(n).alias("batch"), F.lit(outcome).alias("outcome"), "changes")
        row = c.materialize(row, "gap")  # as it is now
        out = row if out is None else out.unionByName(row)
    return out


@register("cdc_torn_batch", O.sql(f"""
WITH n AS (SELECT count(*) FILTER (WHERE batch = 0) AS c0, count(*) AS c1 FROM ({_PER_BATCH} WHERE a.batch <= 1)),
q AS (SELECT count(*) FILTER (WHERE o_orderkey % 10 = 6) AS q0, count(*) FILTER (WHERE o_orderkey % 10 IN (6, 9)) AS q1 FROM orders)
SELECT v.* FROM n, q, LATERAL (VALUES ('before', c0, 1, q0), ('torn', c0, 1, q0), ('again', c1, 2, q1)) AS v(moment, changes, stats, quarantine)"""))
def q_cdc_torn_batch(c):
    """A batch whose last part fails is seen by no reader, in none of its parts; its next attempt is."""
    spark, base, out = c.spark, _base(c.spark, "torn"), None

    def look(moment):
        parts = [df.agg(F.count("*").alias(n)) for n, df in (("changes", stream.changes(spark, base, _target(c))), ("stats", stream.stats(spark, base)), ("quarantine", stream.quarantine(spark, base)))]
        row = parts[0].crossJoin(F.broadcast(parts[1])).crossJoin(F.broadcast(parts[2])).select(F.lit(moment).alias("moment"), "*")  # one row each
        return c.materialize(row, "torn")

    _commit(c, base, 0)
    out = look("before")
    read = _batch_of(c, 1)
    fails = F.when(F.col("pos") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.lit(""))
    good = cdc.compact(cdc.coerce(cdc.decode(read.withColumn("seq", F.struct("batch", "file", "pos", F.lit(1).alias("part")).cast(stream.ORDER))), _target(c), "public", "orders", keep=("seq", "landed_at"), unchanged=True), KEY)
    try:
        mirror.commit(spark, base, 1, {"changes": good, "stats": cdc.batch_stats(good), "quarantine": read.select(fails.alias("reason"))}, {"records": 0}, buckets=[], n_buckets=BUCKETS)
    except mirror.LedgerError:
        raise
    except Exception as e:
        if "lost" not in str(e):
            raise
    out = out.unionByName(look("torn"))
    _commit(c, base, 1)
    return out.unionByName(look("again"))


# Every version of a row: the snapshot, then each change; a price that a change leaves as it was is that of the snapshot.
O.extra("cdc_versions", ["cdc_decoded"], f"""
SELECT -1 AS seq, '0' AS {M}, {', '.join(COLS)} FROM orders
UNION ALL SELECT seq, {M}, d.o_orderkey, d.o_custkey, d.o_orderstatus, CASE WHEN d.o_orderstatus = 'T' THEN o.o_totalprice ELSE d.o_totalprice END, d.o_orderdate, d.o_orderpriority
FROM cdc_decoded d LEFT JOIN orders o ON o.o_orderkey = d.o_orderkey""")


def _feed(c):
    """Snapshot and typed changes as one feed, ordered by line."""
    typed = _typed(c).drop("op")
    seeds = cdc.seed(c.source("orders").select(*COLS)).withColumns({"seq": F.lit(-1).cast("long"), cdc.UNCHANGED_COL: F.array().cast("array<string>")})
    return seeds.select(*typed.columns).unionByName(typed)


_AT = (0, 1, 2)


@register("cdc_as_of", O.sql(" UNION ALL ".join(f"""
SELECT {n} AS moment, {o_cols(COLS)} FROM (SELECT * FROM cdc_versions WHERE seq // 2 % 10 <= {n} QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1) WHERE {M} <> '2'""" for n in _AT), "cdc_versions"))
def q_cdc_as_of(c):
    """The mirror as it was after each of three batches, read from one feed."""
    feed = _feed(c).withColumn("seq", F.struct(F.when(F.col("seq") < 0, -1).otherwise(F.floor(F.col("seq") / 2) % 10).cast("int").alias("batch"), "seq"))
    out = None
    for n in _AT:
        at = F.struct(F.lit(n).alias("batch"), F.lit(2**62).alias("seq"))
        one = mirror.as_of(feed, KEY, at).select(F.lit(n).alias("moment"), *COLS)
        out = one if out is None else out.unionByName(one)
    return out


@register("cdc_mirror_as_of", O.sql(" UNION ALL ".join(f"""
SELECT {n} AS moment, {o_cols(COLS)} FROM (SELECT * FROM cdc_versions WHERE seq // 2 % 10 <= {n} QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1) WHERE {M} <> '2'""" for n in _AT), "cdc_versions"))
def q_cdc_mirror_as_of(c):
    """The same from the written mirror, with a version in between."""
    base, out = _seeded(c, "asof"), None
    for n in _AT:
        _commit(c, base, n)
        if n == 1:
            mirror.compact(c.spark, base, _target(c), KEY, stream.ORDER)
    for n in _AT:
        one = mirror.current(c.spark, base, _target(c), KEY, stream.ORDER, upto=n).select(F.lit(n).alias("moment"), *COLS)
        out = one if out is None else out.unionByName(one)
    return out


@register("cdc_validity", O.sql(f"""
SELECT o_orderkey, {M}, o_orderstatus, seq AS valid_from, lead(seq) OVER (PARTITION BY o_orderkey ORDER BY seq) AS valid_to FROM cdc_versions""", "cdc_versions"))
def q_cdc_validity(c):
    """The time in which each version of a row was the visible one."""
    return mirror.validity(_feed(c), KEY).select(KEY, M, "o_orderstatus", "valid_from", "valid_to")


@register("cdc_version_counts", O.sql(f"""
SELECT count(*) FILTER (WHERE valid_to IS NULL AND {M} <> '2') AS visible, count(*) FILTER (WHERE valid_to IS NOT NULL) AS superseded, count(*) FILTER (WHERE valid_to IS NULL AND {M} = '2') AS deleted
FROM (SELECT {M}, lead(seq) OVER (PARTITION BY o_orderkey ORDER BY seq) AS valid_to FROM cdc_versions)""", "cdc_versions"))
def q_cdc_version_counts(c):
    return mirror.version_counts(mirror.validity(_feed(c), KEY))


@register("cdc_retained", O.sql(f"""
WITH v AS (SELECT count(*) FILTER (WHERE batch >= 3) AS kept, count(*) AS every FROM (SELECT o_orderkey % 12 AS batch FROM orders))
SELECT v.kept AS in_window, v.kept AS after_expiry, (SELECT count(*) FROM orders) AS current_rows FROM v"""))
def q_cdc_retained(c):
    """Twelve daily batches that set one status each; seven days stay in the feed, and no row is lost from the mirror."""
    spark, base, target = c.spark, _seeded(c, "retained"), _target(c)
    k = F.col(KEY)
    value = F.concat(F.lit("table public.orders: UPDATE: o_orderkey[bigint]:"), k, F.lit(" o_orderstatus[text]:'D' o_custkey[bigint]:unchanged-toast-datum"))
    lines = c.source("orders").select((F.floor(k / 12) * 1000 + k % 12).alias("seq"), value.alias("value"), (k % 12).alias("day"))
    for n in range(12):
        day = lines.filter(F.col("day") == n).withColumn("seq", F.lit(10) * F.col("seq")).drop("day")
        _commit(c, base, n, _batch_of(c, 0, day).withColumns({"batch": F.lit(n).cast("long"), "landed_at": F.timestamp_millis(F.lit(1_700_000_000_000 + n * 86_400_000))}))
    window = stream.history(spark, base, target, 8).agg(F.count("*").alias("in_window"))
    window = c.materialize(window, "window")
    mirror.compact(spark, base, target, KEY, stream.ORDER)
    mirror.expire(spark, base, 8)
    after = stream.changes(spark, base, target).agg(F.count("*").alias("after_expiry"))
    rows = mirror.current(spark, base, target, KEY, stream.ORDER).agg(F.count("*").alias("current_rows"))
    return window.crossJoin(F.broadcast(after)).crossJoin(F.broadcast(rows))  # one row each
