"""Helpers shared by the document operators: shared-folder tables, byte hashing, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import scratch_path, ship  # noqa: F401

#: Largest side that an explicit broadcast may have, in bytes as estimated by its caller.
BROADCAST_BYTES = 32 << 20


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's checkpoint folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if ``rows`` rows of about ``row_bytes`` stay under the bound, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def text_key(text: Column) -> Column:
    """128 bits that tell rows of one id, or without an id, apart by their text; null is empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ASCII texts take the cheap function."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


# --- bytes inside a task -------------------------------------------------------------------------

_RNG = np.random.default_rng(7919)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, as far as the longest text so far."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) <= n:
            size = 1 << max(16, int(n).bit_length())
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(size + 1, base, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def prefix_hash(b: np.ndarray) -> np.ndarray:
    """Running sums of byte values times powers of the base; ``span_hash`` reads the hash of any span from it."""
    _Powers.reach(len(b))
    out = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * _Powers.up[: len(b)], out=out[1:])
    return out


def inverse_powers(n: int) -> np.ndarray:
    _Powers.reach(n)
    return _Powers.down[:n]


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * _Powers.down[start])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each run of true flags."""
    d = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow column, without copies; null is empty."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        part = part.cast(pa.large_binary())
        _, at, data = part.buffers()
        offsets = np.frombuffer(at, dtype=np.int64)[part.offset: part.offset + len(part) + 1] if at else np.zeros(1, np.int64)
        raw = np.frombuffer(data, dtype=np.uint8) if data and data.size else np.zeros(0, np.uint8)
        valid = part.is_valid().to_numpy(zero_copy_only=False)
        for i in range(len(part)):
            yield raw[offsets[i]: offsets[i + 1]] if valid[i] else raw[:0]


# --- components ----------------------------------------------------------------------------------

def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (its smallest reachable node) for every node of ``edges``.

    Alternates large-star and small-star steps until the edges stop changing: each step is one shuffle over the
    edges, and the number of steps grows with the logarithm of the longest path. A null end makes no edge.
    """
    u, v = F.col("u"), F.col("v")
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e = materialize(e.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("v", "u")) if large else e
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(low, "u")
        if large:
            out = out.where("v > u").select(v.alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(v.alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    key = lambda e: e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    was = key(e)
    while True:
        e = materialize(star(star(e, True), False), "edges")
        now = key(e)
        if now == was:
            break
        was = now
    roots = e.select(v.alias("node"), v.alias("component")).distinct()
    return e.select(u.alias("node"), v.alias("component")).union(roots)
