"""A mirror that readers may use while it is written: a ledger of batches and versions made of buckets.

    data/<unique>/<part>/        what one attempt at a batch wrote: changes, stats, quarantine
    ledger/<batch>               the batch's record, created when all parts are there; only then readers see any of them
    rows/<unique>/bucket=<n>/    rows of the buckets that one compaction touched
    versions/<version>           the folder of each bucket and the last batch folded into it
    horizon/<batch>              batches up to this one have been deleted

Batches are numbered without gaps. A batch that leaves one out, or that comes again with other content, is refused; one
that comes again with the same content changes nothing. An attempt that fails leaves a folder that no record names.

Rows lie in ``pmod(xxhash64(key), n)`` buckets. A compaction reads and rewrites only the buckets that its changes touch, into
a folder of its own, and then adds a version that names, for all other buckets, the folders they had. Nothing that a
version names is ever overwritten, so readers and a failed compaction do not disturb each other. ``current`` reads the last
version and the batches behind it; buckets without newer changes are only scanned.

Records are written under another name and renamed, which on a cluster's file system is atomic and never replaces a record;
the local file system of tests has one writer. Records hold one line a bucket at most; a driver never sees rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import cdc

BUCKET = "bucket"


class LedgerError(RuntimeError):
    """A batch or version that does not fit behind the last one."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _records(spark: SparkSession, base: str, kind: str) -> list[dict]:
    fs, p = _fs(spark, f"{base}/{kind}")
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    out = []
    for name in names:
        if name.isdigit():
            stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{kind}/{name}"))
            try:
                out.append(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
    return out


def _put(spark: SparkSession, base: str, kind: str, number: int, record: dict) -> None:
    """Add a record; an error if that number is taken."""
    path = f"{base}/{kind}/{number:020d}"
    fs, p = _fs(spark, path)
    _, tmp = _fs(spark, f"{base}/{kind}/_{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise LedgerError(f"{kind} {number} is there already")


def _written(spark: SparkSession, path: str) -> None:
    fs, done = _fs(spark, f"{path}/_SUCCESS")
    if not fs.exists(done):
        raise RuntimeError(f"{path} was not committed")


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


# --- ledger --------------------------------------------------------------------------------------

def ledger(spark: SparkSession, base: str) -> list[dict]:
    """The records of all batches, oldest first."""
    return _records(spark, base, "ledger")


def check_gap(spark: SparkSession, base: str, batch: int) -> None:
    """An error if a batch leaves one out; what it is made of need not be known."""
    known = ledger(spark, base)
    last = known[-1] if known else None
    if batch > (last["batch"] + 1 if last else 0) or batch < 0:
        raise LedgerError(f"batch {batch} leaves a gap behind {last['batch'] if last else 'the start'}")


def admit(spark: SparkSession, base: str, batch: int, source: dict) -> bool:
    """Whether a batch is the next one: False if it is in the ledger with the same content, an error if it does not fit."""
    known = ledger(spark, base)
    last = known[-1] if known else None
    if last and batch <= last["batch"]:
        same = next((r for r in known if r["batch"] == batch), None)
        if same is None or same["source"] != source:
            raise LedgerError(f"batch {batch} is in the ledger with another content")
        return False
    check_gap(spark, base, batch)
    if "first" in source and last and "last" in last["source"] and source["first"] != last["source"]["last"] + 1:
        raise LedgerError(f"batch {batch} starts at {source['first']}, the batch before ends at {last['source']['last']}")
    return True


def commit(spark: SparkSession, base: str, batch: int, parts: dict[str, DataFrame], source: dict, **info) -> str:
    """Write the ``parts`` of a batch and then its record, all or nothing. ``source`` tells what the batch was made from; with
    ``first`` and ``last`` in it, these numbers follow those of the batch before. Returns "committed" or "replayed"."""
    if not admit(spark, base, batch, source):
        return "replayed"
    folder = f"data/{batch:020d}-{uuid.uuid4().hex[:12]}"
    for name, df in parts.items():
        df.write.option("compression", "zstd").parquet(f"{base}/{folder}/{name}")
        _written(spark, f"{base}/{folder}/{name}")
    _put(spark, base, "ledger", batch, {"batch": batch, "folder": folder, "source": source, **info})
    return "committed"


def horizon(spark: SparkSession, base: str) -> int:
    """The last batch that retention has deleted, -1 if none."""
    return max((r["batch"] for r in _records(spark, base, "horizon")), default=-1)


def read_part(spark: SparkSession, base: str, part: str, schema: T.StructType, after: int = -1, upto: int | None = None) -> DataFrame:
    """One part of the batches ``after`` .. ``upto`` that are in the ledger; nothing else is looked at."""
    if after < (gone := horizon(spark, base)):
        after = gone if after == -1 else after
        if after < gone:
            raise LedgerError(f"batches up to {gone} have been deleted")
    paths = [f"{base}/{r['folder']}/{part}" for r in ledger(spark, base) if r["batch"] > after and (upto is None or r["batch"] <= upto)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def check_landing(spark: SparkSession, base: str, source_dir: str) -> list[int]:
    """The numbers of new change files (``<number>.<ext>``) behind the ledger's last one; an error if one is missing, before
    a stream takes the files behind it into a batch."""
    known = ledger(spark, base)
    last = known[-1]["source"].get("last", -1) if known else -1
    fs, p = _fs(spark, source_dir)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    numbers = sorted(int(n.split(".")[0]) for n in names if n.split(".")[0].isdigit())
    new = [n for n in numbers if n > last]
    missing = sorted(set(range(last + 1, new[-1] + 1)) - set(new))[:10] if new else []
    if missing:
        raise LedgerError(f"change files are missing: {missing}")
    return new


# --- versions ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Version:
    number: int
    through: int
    buckets: int
    folders: dict[int, str] = field(default_factory=dict)  # buckets without rows have none


def versions(spark: SparkSession, base: str) -> list[Version]:
    return [Version(r["version"], r["through"], r["buckets"], {int(k): v for k, v in r["folders"].items()}) for r in _records(spark, base, "versions")]


def _arm(spark: SparkSession, base: str, v: Version) -> Version:
    _put(spark, base, "versions", v.number, {"version": v.number, "through": v.through, "buckets": v.buckets, "folders": v.folders})
    return v


def _write_buckets(rows: DataFrame, base: str, buckets: int, key: str, files: int) -> dict[int, str]:
    """Rows as bucket folders, ``files`` files each; the folder of each bucket that has rows."""
    spark = rows.sparkSession
    folder = f"rows/{uuid.uuid4().hex[:12]}"
    placed = rows.withColumn(BUCKET, bucket_of(key, buckets)).withColumn("__f", F.pmod(F.hash(key), F.lit(files)))
    placed.repartition(BUCKET, "__f").drop("__f").write.partitionBy(BUCKET).option("compression", "zstd").parquet(f"{base}/{folder}")
    _written(spark, f"{base}/{folder}")
    fs, p = _fs(spark, f"{base}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}


def seed_version(seed: DataFrame, base: str, key: str, buckets: int = 64, files: int = 1) -> Version:
    """Version 0: the snapshot that the feed starts from."""
    return _arm(seed.sparkSession, base, Version(0, -1, buckets, _write_buckets(seed.filter(F.col(key).isNotNull()), base, buckets, key, files)))


def _read_rows(spark: SparkSession, base: str, v: Version, schema: T.StructType, which) -> DataFrame:
    paths = [f"{base}/{f}" for b, f in sorted(v.folders.items()) if which(b)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def feed_schema(target: T.StructType, order: str) -> T.StructType:
    extra = T.StructType.fromDDL(f"seq {order}, landed_at timestamp, {cdc.UNCHANGED_COL} array<string>, {cdc.ROW_MARKER} string")
    return T.StructType(list(target.fields) + extra.fields)


def _newer(spark: SparkSession, base: str, v: Version, target: T.StructType, key: str, order: str, upto: int | None) -> tuple[DataFrame, set[int], int]:
    """The last change of each key behind a version, the buckets they touch and the last batch."""
    records = [r for r in ledger(spark, base) if r["batch"] > v.through and (upto is None or r["batch"] <= upto)]
    changes = read_part(spark, base, "changes", feed_schema(target, order), v.through, upto).drop("landed_at")
    touched = {b for r in records for b in r["buckets"]} if all(r.get("n_buckets") == v.buckets for r in records) else set(range(v.buckets))
    return cdc.compact(changes, key, "seq"), touched, max((r["batch"] for r in records), default=v.through)


def compact(spark: SparkSession, base: str, target: T.StructType, key: str, order: str, files: int = 1) -> Version:
    """Fold the batches behind the last version into a new one; only touched buckets are read and written."""
    v = versions(spark, base)[-1]
    last, touched, through = _newer(spark, base, v, target, key, order, None)
    if through == v.through:
        return v
    rows = cdc.apply(_read_rows(spark, base, v, target, touched.__contains__), last, key)
    new = _write_buckets(rows, base, v.buckets, key, files)
    kept = {b: f for b, f in v.folders.items() if b not in touched}
    return _arm(spark, base, Version(v.number + 1, through, v.buckets, kept | new))


def current(spark: SparkSession, base: str, target: T.StructType, key: str, order: str, upto: int | None = None) -> DataFrame:
    """The mirror as of the batch ``upto`` (default: the last): the newest version not behind it, and the batches since."""
    fitting = [v for v in versions(spark, base) if upto is None or v.through <= upto]
    if not fitting:
        raise LedgerError(f"no version is as old as batch {upto}")
    v = fitting[-1]
    last, touched, _ = _newer(spark, base, v, target, key, order, upto)
    rest = _read_rows(spark, base, v, target, lambda b: b not in touched)
    if not touched:
        return rest
    return rest.unionByName(cdc.apply(_read_rows(spark, base, v, target, touched.__contains__), last, key))


def expire(spark: SparkSession, base: str, retain_days: int = 7, keep_versions: int = 1) -> int:
    """Delete batches that landed more than ``retain_days`` before the newest and that every kept version holds, then versions
    beyond the last ``keep_versions`` with the folders only they name. Returns the new horizon."""
    known, vs = ledger(spark, base), versions(spark, base)
    gone = horizon(spark, base)
    kept = vs[-keep_versions:]
    folded = min((v.through for v in kept), default=-1)
    newest = max((r["landed"] for r in known if r.get("landed")), default=0)
    old = [r for r in known if gone < r["batch"] <= folded and r.get("landed") is not None and r["landed"] < newest - retain_days * 86_400_000]
    old = [r for k, r in enumerate(old) if r["batch"] == gone + 1 + k]  # from the oldest on, without a hole
    if old:
        gone = old[-1]["batch"]
        _put(spark, base, "horizon", gone, {"batch": gone})
    needed = {f for v in kept for f in v.folders.values()}
    drop = [r["folder"] for r in old] + [f for v in vs[:-keep_versions] for f in v.folders.values() if f not in needed]
    drop += [f"versions/{v.number:020d}" for v in vs[:-keep_versions]]
    for path in drop:
        fs, p = _fs(spark, f"{base}/{path}")
        fs.delete(p, True)
    return gone


# --- history -------------------------------------------------------------------------------------

def validity(feed: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Each change with ``valid_to``: the order of its key's next change, NULL for the last one (``valid_from`` is its own).

    The feed is range-sorted by key and order, so that a key with many changes gets several tasks. Within a range the next
    change is the next row; the last row of a key in a range takes the key's first order in a later range."""
    from ..session import scratch_path

    spark = feed.sparkSession
    path = scratch_path(spark, "validity")
    feed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), key, seq).withColumn("__p", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(T.StructType([*feed.schema.fields, T.StructField("__p", T.IntegerType())])).parquet(path)
    per = ranged.groupBy(key, "__p").agg(F.min(seq).alias("__first"))  # a row for each key and range it is in
    later = per.withColumn("__later", F.lead("__first").over(Window.partitionBy(key).orderBy("__p"))).where("__later IS NOT NULL").select(F.col(key).alias("__k"), F.col("__p").alias("__q"), "__later")
    inside = ranged.withColumn("__next", F.lead(seq).over(Window.partitionBy("__p", key).orderBy(seq)))
    out = inside.join(later, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__p") == F.col("__q")), "left")
    return out.select(*feed.columns, F.col(seq).alias("valid_from"), F.coalesce("__next", "__later").alias("valid_to"))


def as_of(feed: DataFrame, key: str, at, seq: str = "seq") -> DataFrame:
    """The rows that were visible after all changes up to ``at``; ``feed`` holds the snapshot as inserts."""
    last = cdc.compact(feed.filter(F.col(seq) <= at), key, seq)
    return last.filter(F.col(cdc.ROW_MARKER) != cdc.MARKERS["DELETE"]).drop(cdc.ROW_MARKER, cdc.UNCHANGED_COL)


def version_counts(intervals: DataFrame) -> DataFrame:
    """Rows that a reader sees, versions that later ones supersede, and keys whose last change is a delete."""
    last = F.col("valid_to").isNull()
    deleted = F.col(cdc.ROW_MARKER) == cdc.MARKERS["DELETE"]
    return intervals.agg(F.count_if(last & ~deleted).alias("visible"), F.count_if(~last).alias("superseded"), F.count_if(last & deleted).alias("deleted"))
