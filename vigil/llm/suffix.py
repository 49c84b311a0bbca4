"""Exact substring deduplication: every byte inside a string of ``length`` bytes that starts more than once goes.

1. Every start of a ``length``-byte string is keyed by the smallest ``gram``-byte hash inside it. Starts next to each
   other with the same key form a region: equal strings have equal keys, so they meet, and each start is in one
   region only. Texts are scanned once and give a few narrow rows.
2. Keys of one region drop out, unless it comes twice inside that region. Regions with the same bytes
   as another region are covered whole: every string in them starts there too.
3. The different texts of a key, one of each, go to suffix-array shards: suffixes are classified, leftmost-smaller
   substrings sorted by induction and recursively by their names, the shard's array is induced from them in linear
   time, and permuted common prefixes (by text place, each at most one shorter than the one before) tell which starts
   share ``length`` bytes with a neighbour. Texts of a key go to one shard. A key whose texts are too long for a shard
   is settled by the exact digests of its strings instead, a row for each start, counted by Spark.
4. Covered starts go back to every region with those bytes, and are merged into spans for each document.

Defined results: null is empty; texts shorter than ``length`` have no such string; repeated rows repeat each other, so
all their strings go; rows of one id with other texts are other documents; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import inverse_powers, materialize, mix, prefix_hash, runs, text_bytes

LENGTH, GRAM = 400, 128
#: Bytes of different texts that one key may bring to a shard, and that a shard should hold.
KEY_BYTES, SHARD_BYTES = 4 << 20, 2 << 20


# --- suffix arrays by induced sorting ---------------------------------------------------------------

def _types(t: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the one to their right; the last, a unique smallest sign, is one."""
    n = len(t)
    out = np.ones(n, dtype=bool)
    if n > 1:
        less, same = t[:-1] < t[1:], t[:-1] == t[1:]
        # Equal signs take the type of the next unequal place to their right.
        at = np.where(same, n, np.arange(n - 1))
        nearest = np.minimum.accumulate(at[::-1])[::-1]
        out[:-1] = np.where(nearest < n - 1, less[np.minimum(nearest, n - 2)], True)
    return out


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the order ``lms`` of leftmost-smaller suffixes, a bucket at a time."""
    k, n = len(sizes), len(t)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    sa = np.full(n, -1, dtype=np.int32)
    large = ~small
    by = t[lms]
    order = np.argsort(by, kind="stable")
    lms, by = lms[order], by[order]
    cut = np.searchsorted(by, np.arange(k + 1))
    fill = heads.copy()

    def spread(src: np.ndarray, want: np.ndarray, fill: np.ndarray, step: int) -> np.ndarray:
        """Puts the predecessors of ``src`` that are of the wanted type into their buckets; returns them with buckets."""
        p = src[src > 0] - 1
        p = p[want[p]]
        if not len(p):
            return p
        c = t[p]
        o = np.argsort(c, kind="stable")
        p, c = p[o], c[o]
        first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        counts = np.diff(np.append(first, len(c)))
        nth = np.arange(len(c)) - np.repeat(first, counts)
        if step > 0:
            sa[fill[c] + nth] = p
        else:
            sa[fill[c] - 1 - nth] = p
        fill[c[first]] += step * counts
        return p

    for c in range(k):  # larger suffixes, from the left
        done = heads[c]
        while done < fill[c]:
            upto = fill[c]
            spread(sa[done:upto], large, fill, 1)
            done = upto
        spread(lms[cut[c]: cut[c + 1]], large, fill, 1)
    tail = ends.copy()
    for c in range(k - 1, -1, -1):  # smaller suffixes, from the right
        done = ends[c]
        while done > tail[c]:
            upto = tail[c]
            spread(sa[upto:done][::-1], small, tail, -1)
            done = upto
        spread(sa[heads[c]: fill[c]][::-1], small, tail, -1)
    sa[0] = n - 1
    return sa


def _induce_plain(t: list[int], small: list[bool], lms: list[int], sizes: np.ndarray) -> np.ndarray:
    """As ``_induce``, one suffix at a time: for names, which are many and whose buckets are short."""
    n = len(t)
    ends = np.cumsum(sizes).tolist()
    heads = [e - s for e, s in zip(ends, sizes.tolist(), strict=True)]
    # Empty places hold 0, which has no predecessor; index -1 is the last sign, of neither kind here.
    sa, tail = [0] * n, ends[:]
    for p in reversed(lms):
        c = t[p]
        tail[c] -= 1
        sa[tail[c]] = p
    large = [not x for x in small]
    for x in sa:  # sees what it puts further on
        if large[x - 1]:
            c = t[x - 1]
            sa[heads[c]] = x - 1
            heads[c] += 1
    tail, inner = ends, small[:-1] + [False]
    for x in reversed(sa):
        if inner[x - 1]:
            c = t[x - 1]
            tail[c] -= 1
            sa[tail[c]] = x - 1
    sa[0] = n - 1
    return np.array(sa, dtype=np.int64)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Of whole numbers 0..k without gaps at the end, whose last is the only 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    small = _types(t)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    sizes = np.bincount(t)
    if len(sizes) <= 300:
        induce = lambda order: _induce(t, small, order, sizes)
    else:
        a, b = t.tolist(), small.tolist()
        induce = lambda order: _induce_plain(a, b, order.tolist(), sizes)
    sa = induce(lms)
    if len(lms) > 1:
        found = sa[is_lms[sa]]  # leftmost-smaller substrings in order
        # Names: equal substrings (with both their ends) share one.
        end = np.empty(n, dtype=np.int64)
        end[lms] = np.append(lms[1:], n - 1)
        width = end[found] - found + 1
        new = np.ones(len(found), dtype=bool)
        alike = np.flatnonzero(width[1:] == width[:-1]) + 1
        if len(alike):
            p, q, w = found[alike - 1], found[alike], width[alike]
            differs = np.zeros(len(alike), dtype=bool)
            at, k = np.arange(len(alike)), 0
            while len(at):
                d = t[p[at] + k] != t[q[at] + k]
                differs[at[d]] = True
                k += 1
                at = at[~d & (w[at] > k)]
            new[alike] = differs
        name = np.empty(n, dtype=np.int64)
        name[found] = np.cumsum(new) - 1
        names = name[lms]
        if new.all():
            order = found
        else:
            order = lms[suffix_array(names)]
        sa = induce(order)
    return sa


def shared_starts(text: np.ndarray, sa: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """True at places whose suffix has ``length`` signs in common, and not beyond its own text (``left`` signs),
    with the one before or after it in the array. Permuted common prefixes: in text order, each is at least the one
    before it less one."""
    n = len(sa)
    before = np.empty(n, dtype=np.int32)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    # Only runs where place and predecessor both step by one, and have a sign in common, extend one another; compare a
    # whole run at once. Behind a place whose sign is not its predecessor's nothing is known: a new run.
    place = np.arange(n, dtype=np.int32)
    gap = np.where(before >= 0, place - before, n + 1)
    fresh = np.diff(gap, prepend=gap[0] - 1) != 0
    fresh[1:] |= text[:-1] != text[before[:-1]]
    starts = np.flatnonzero(fresh)
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    first, prior = starts, before[starts]
    # Common length of each run's first place; others of the run have one less each. It is enough to know up to
    # ``length`` beyond the run's end.
    size = np.diff(np.append(starts, n))
    most = np.minimum(size + length, np.minimum(n - first, n - np.maximum(prior, 0)))
    live, k = np.flatnonzero(prior >= 0), np.zeros(len(starts), dtype=np.int64)
    block = 16
    padded = np.concatenate((text, np.arange(block) - 1 - block))
    while len(live):
        a, b = first[live] + k[live], prior[live] + k[live]
        out = np.empty(len(live), dtype=np.int64)
        for s in range(0, len(live), 50_000):
            u, v = a[s: s + 50_000, None] + np.arange(block), b[s: s + 50_000, None] + np.arange(block)
            same = padded[np.minimum(u, len(padded) - 1)] == padded[np.minimum(v, len(padded) - 1)]
            out[s: s + 50_000] = np.where(same.all(1), block, same.argmin(1))
        k[live] += out
        live = live[(out == block) & (k[live] < most[live])]
    plcp = np.maximum(k[run] - (place - starts[run]), 0)
    hit = (plcp >= length) & (before >= 0)
    good = np.zeros(n, dtype=bool)
    good[place[hit]] = True
    good[before[hit]] = True
    return good & (left >= length)


def repeated(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the places where a string of ``length`` bytes starts that also starts elsewhere in ``texts``."""
    if not texts:
        return []
    sizes = np.array([len(x) for x in texts])
    # Bytes become 2.., each text ends with a 1, all ends with the only 0.
    t = np.ones(sizes.sum() + len(texts) + 1, dtype=np.int32)
    left = np.zeros(len(t), dtype=np.int32)
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    for x, a in zip(texts, at[:-1], strict=True):
        t[a: a + len(x)] = np.frombuffer(x, np.uint8).astype(np.int32) + 2
        left[a: a + len(x)] = np.arange(len(x), 0, -1)
    t[-1] = 0
    dense = np.zeros(258, dtype=np.int32)
    met = np.unique(t)
    dense[met] = np.arange(len(met))
    good = shared_starts(t, suffix_array(dense[t]), left, length)
    return [np.flatnonzero(good[a: a + n]) for a, n in zip(at[:-1], sizes, strict=True)]


# --- regions ---------------------------------------------------------------------------------------

def regions(b: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, first start and number of starts of each region of a text, and whether its key comes twice inside it."""
    if len(b) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    p = prefix_hash(b)
    n = len(b) - gram + 1
    h = mix((p[gram:] - p[:n]) * inverse_powers(n))
    w = length - gram + 1  # grams of a string
    starts = len(b) - length + 1
    blocks = -(-n // w)
    grid = np.full(blocks * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    grid[:n] = h
    grid = grid.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:starts], ahead[w - 1: w - 1 + starts])
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    key, count = least[first], np.diff(np.append(first, starts))
    again = np.array([np.count_nonzero(h[a: a + c + w - 1] == k) > 1 for k, a, c in zip(key, first.tolist(), count.tolist(), strict=True)], dtype=bool)
    return key, first, count, again


def _region_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, keys, digests, firsts, counts, twice = [], [], [], [], [], []
        for i, b in enumerate(text_bytes(batch.column(2))):
            k, first, n, again = regions(b, length, gram)
            data = b.tobytes()
            rows += [i] * len(k)
            keys.append(k.view(np.int64))
            digests += [xxhash.xxh3_128_digest(data[a: a + c + length - 1]) for a, c in zip(first.tolist(), n.tolist(), strict=True)]
            firsts.append(first)
            counts.append(n)
            twice += again.tolist()
        flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        at = pa.array(rows, pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(flat(keys), pa.int64()), pa.array(digests, pa.binary()), pa.array(flat(firsts), pa.int32()), pa.array(flat(counts), pa.int32()), pa.array(twice, pa.bool_())], ["id", "sum", "key", "digest", "first", "n", "again"])


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted regions of each text."""
    for batch in batches:
        out = []
        for want, b in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            data = b.tobytes()
            out += [(x["key"], x["digest"], data[x["first"]: x["first"] + x["n"] + length - 1]) for x in want]
        cols = list(zip(*out, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], ["key", "digest", "body"])


def _places(at: np.ndarray) -> list[dict]:
    """Runs of places as start and number."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    first = at[np.concatenate(([0], cut))]
    return [{"first": int(a), "n": int(c)} for a, c in zip(first, np.diff(np.concatenate(([0], cut, [len(at)]))), strict=True)]


def _sort_shard(table: pa.Table, length: int) -> pa.Table:
    t = table.sort_by([("key", "ascending"), ("digest", "ascending")])
    found = [_places(at) for at in repeated(t["body"].to_pylist(), length)]
    return pa.Table.from_arrays([t["key"].combine_chunks(), t["digest"].combine_chunks(), pa.array(found, pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())])))], ["key", "digest", "hits"])


def _string_digests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, digest, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            each = [xxhash.xxh3_128_digest(body[i: i + length]) for i in range(len(body) - length + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(each), pa.int64()), pa.array([digest] * len(each), pa.binary()), pa.array(range(len(each)), pa.int32()), pa.array(each, pa.binary())], ["key", "digest", "at", "string"])


def _remove(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, kept, sizes, gone = [], [], [], []
        for hits, b in zip(batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
            out = np.zeros(len(b) + 1, dtype=np.int32)
            for x in hits or ():
                out[x["first"]] += 1
                out[x["first"] + x["n"] + length - 1] -= 1
            flag = np.cumsum(out[:-1]) > 0
            a, z = runs(flag)
            spans.append([{"start": int(i), "stop": int(j)} for i, j in zip(a, z, strict=True)])
            kept.append(b[~flag].tobytes())
            sizes.append(len(b))
            gone.append(int(flag.sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   key_bytes: int = KEY_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id, n_bytes, n_removed, spans`` (of bytes removed) and ``kept`` (the bytes left), for every input row."""
    gram = min(gram, length)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    two = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("sum"), text.alias("text"))  # rows of one id may have other texts
    kind = two.schema["id"].dataType.simpleString()
    rows = materialize(two.mapInArrow(lambda it: _region_rows(it, length, gram), f"id {kind}, sum long, key long, digest binary, first int, n int, again boolean"), "regions")
    # Different texts of each key: how many there are, how often each comes.
    texts = rows.groupBy("key", "digest").agg(F.count("*").alias("times"), F.min(F.struct("id", "sum", "first")).alias("one"), F.first("n").alias("n"), F.first("again").alias("again"))
    keys = texts.groupBy("key").agg(F.sum("times").alias("all"), F.count("*").alias("kinds"), F.max("again").alias("any_again"), F.sum(F.col("n") + length).alias("octets"))
    keys = keys.where((F.col("all") > 1) | F.col("any_again"))
    texts = materialize(texts.join(keys, "key"), "region_texts")
    twins = texts.where("times > 1").select("key", "digest", F.array(F.struct(F.lit(0).alias("first"), F.col("n").alias("n"))).alias("hits"))
    apart = texts.where((F.col("kinds") > 1) | F.col("again"))
    want = apart.groupBy(F.col("one.id").alias("of"), F.col("one.sum").alias("sum")).agg(F.collect_list(F.struct("key", "digest", F.col("one.first").alias("first"), "n")).alias("want"))
    mine = F.col("d.id").eqNullSafe(F.col("w.of")) & (F.col("d.sum") == F.col("w.sum"))
    bodies = two.alias("d").join(want.alias("w"), mine).select("want", "text").mapInArrow(lambda it: _cut_out(it, length), "key long, digest binary, body binary")
    bodies = materialize(bodies.dropDuplicates(["key", "digest"]).join(keys.select("key", "octets"), "key"), "region_bodies")
    total = bodies.where(F.col("octets") <= key_bytes).agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    sorted_ = bodies.where(F.col("octets") <= key_bytes).withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(
        lambda t: _sort_shard(t, length), "key long, digest binary, hits array<struct<first:int,n:int>>")
    strings = bodies.where(F.col("octets") > key_bytes).select("key", "digest", "body").mapInArrow(lambda it: _string_digests(it, length), "key long, digest binary, at int, string binary")
    strings = materialize(strings, "region_strings")
    often = strings.groupBy("string").count().where("count > 1").select("string")
    settled = strings.join(often, "string").groupBy("key", "digest").agg(F.transform(F.array_sort(F.collect_list("at")), lambda i: F.struct(i.alias("first"), F.lit(1).alias("n"))).alias("hits"))
    hits = twins.union(sorted_.where(F.size("hits") > 0)).union(settled)
    hits = hits.groupBy("key", "digest").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    covered = rows.select("id", "sum", "key", "digest", F.col("first").alias("base")).join(hits, ["key", "digest"])
    covered = covered.select("id", "sum", F.transform("hits", lambda h: F.struct((F.col("base") + h["first"]).alias("first"), h["n"].alias("n"))).alias("hits"))
    covered = covered.groupBy(F.col("id").alias("of"), "sum").agg(F.flatten(F.collect_set("hits")).alias("hits"))
    found = two.alias("d").join(covered.alias("w"), mine, "left").select("d.id", "hits", "text")
    return found.mapInArrow(lambda it: _remove(it, length), f"id {kind}, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary")
