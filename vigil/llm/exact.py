"""Exact deduplication over content-defined chunk recipes.

Each text is normalised (every run of spaces and ASCII control white space becomes one space) and cut where a rolling
hash of the last bytes meets a mask, so equal stretches give equal chunks wherever they stand. The chunk bytes cross
the network once, each distinct chunk once a task at most, and are compared there: every distinct chunk gets a
verified identifier, its digest and its place among different chunks of that digest. A document is then its ordered
list of identifiers, and only these short lists are grouped. Long documents are not moved or compared again.

Defined results: null counts as empty; an empty text has an empty recipe and equals other empty texts; repeated rows
are copies; of equal texts the row with the smallest id stays (of repeated rows of that id, each is marked kept);
a null id stays only where no other id is in its group. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, materialize, prefix_hash, span_hash, text_bytes

#: Least, mean (a power of two above the least) and greatest bytes of a chunk; bytes that decide a cut.
LEAST, MEAN, MOST, LOOK = 1024, 4096, 16384, 48


def normalise(b: np.ndarray) -> np.ndarray:
    space = SPACE[b]
    keep = ~space
    keep[0:1] |= space[0:1]
    keep[1:] |= space[1:] & ~space[:-1]
    out = b[keep]
    out[SPACE[out]] = 0x20
    return out


def cut(b: np.ndarray) -> list[int]:
    """Ends of the chunks of ``b``, decided by the bytes before them."""
    if len(b) <= LEAST:
        return [len(b)] if len(b) else []
    p = prefix_hash(b)
    at = np.arange(LOOK, len(b) + 1)
    good = at[span_hash(p, at - LOOK, at) & np.uint64(MEAN - 1) == 0]
    ends, last = [], 0
    while len(b) - last > LEAST:
        i = np.searchsorted(good, last + LEAST)
        end = min(int(good[i]) if i < len(good) else len(b), last + MOST, len(b))
        ends.append(end)
        last = end
    return ends + [len(b)] * (last < len(b))


def _digest(chunk: bytes, bits: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[: bits // 8]


def _recipes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums, recipes = [], []
        for raw in text_bytes(batch.column(1)):
            b = normalise(raw)
            data, last, out = b.tobytes(), 0, []
            for end in cut(b):
                out.append(_digest(data[last:end], bits))
                last = end
            sums.append(hashlib.sha256(data).hexdigest())
            recipes.append(out)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.string()), pa.array(recipes, pa.list_(pa.binary()))], ["id", "sha256", "recipe"])


def _chunks(batches: Iterator[pa.RecordBatch], bits: int, seen_most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Each chunk once, as far as the task remembers: forgetting only sends a chunk again."""
    seen: set[bytes] = set()
    for batch in batches:
        digests, bodies = [], []
        for raw in text_bytes(batch.column(0)):
            b = normalise(raw)
            data, last = b.tobytes(), 0
            for end in cut(b):
                body = data[last:end]
                last = end
                own = hashlib.sha256(body).digest()  # not the identifier's digest, which another chunk may share
                if own not in seen:
                    seen.add(own)
                    digests.append(_digest(body, bits))
                    bodies.append(body)
        if len(seen) > seen_most:
            seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())], ["digest", "body"])


def _members(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, places, digests, bodies = [], [], [], []
        for key, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            b = normalise(raw)
            data, last = b.tobytes(), 0
            for k, end in enumerate(cut(b)):
                keys.append(key)
                places.append(k)
                digests.append(_digest(data[last:end], bits))
                bodies.append(data[last:end])
                last = end
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(places, pa.int32()), pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())], ["sha256", "place", "digest", "body"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 128) -> DataFrame:
    """One row for each input row: ``id, keep_id, group_size, kept, text_sha256, n_chunks``."""
    kind = docs.schema[id_col].dataType.simpleString()
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    made = materialize(two.mapInArrow(lambda it: _recipes(it, digest_bits), f"id {kind}, sha256 string, recipe array<binary>"), "recipes")
    chunks = two.select("text").mapInArrow(lambda it: _chunks(it, digest_bits), "digest binary, body binary").distinct()
    # Digests of two or more different chunks, and those chunks: none, but for accidents. The bytes decide.
    clashes = chunks.groupBy("digest").agg(F.count("*").alias("n"), F.collect_list(F.sha2("body", 256)).alias("bodies")).where("n > 1")
    clashes = materialize(clashes.select("digest", F.array_sort("bodies").alias("bodies")), "clashes")
    made = made.withColumn("ids", F.transform("recipe", lambda d: F.struct(d.alias("digest"), F.lit(1).alias("nth"))))
    if not clashes.isEmpty():
        hit = made.select("id", "sha256", F.explode("recipe").alias("digest")).join(clashes.select("digest"), "digest").select(F.col("id").alias("of"), F.col("sha256").alias("s")).distinct()
        again = two.withColumn("s", F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), 256))
        again = again.join(hit, again["id"].eqNullSafe(hit["of"]) & (again["s"] == hit["s"])).select(again["s"], "text")
        parts = again.mapInArrow(lambda it: _members(it, digest_bits), "sha256 string, place int, digest binary, body binary").join(clashes, "digest", "left")
        parts = parts.select("sha256", "place", F.struct("digest", F.coalesce(F.array_position("bodies", F.sha2("body", 256)).cast("int"), F.lit(1)).alias("nth")).alias("one"))
        own = parts.distinct().groupBy("sha256").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "one"))), lambda x: x["one"]).alias("own"))
        made = made.join(own, "sha256", "left").withColumn("ids", F.coalesce("own", "ids")).drop("own")
    groups = made.groupBy("ids").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    made, groups = made.alias("m"), groups.alias("g")
    return made.join(groups, F.col("m.ids") == F.col("g.ids")).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha256").alias("text_sha256"), F.size("recipe").alias("n_chunks"))
