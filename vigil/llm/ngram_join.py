"""Exact n-gram Jaccard join by grouped prefixes, and the classes it makes.

A document's set is its distinct ``width``-word shingles (64-bit hashes). Two sets link when
``100 * |A & B| >= percent * |A | B|``. Steps, each over all rows:

1. Equal sets become one entry; all that follows is about different sets.
2. In any fixed order, linked sets share ``l`` elements in their first ``n - ceil(t n) + l``. By hash order, only these
   prefixes are shuffled; sets with fewer shared elements there than ``l`` link with nothing and go (an exact test).
3. The sets left count every element. Rare elements come first, those in one set only first of all; a set whose
   prefix ``n - ceil(t n) + 1`` has nothing but these goes too.
4. Sets with the same size and the same prefix form one group.
5. Each group's members are verified against its first member, and each group against that group of every prefix
   element that has the fewest elements of its own; then, where an element still has several classes, groups units (step 6) against
   their neighbours in a shuffled order. Each time there are no more pairs than prefix elements,
   and families of near copies, hot ones too, become classes without pairing their members.
6. What is left are pairs of different classes. Within an element, every unit (the members of a group in one class)
   outside the element's largest class meets the units of other classes; size, position and signature filters come
   first, then units are expanded to members and verified. Pairs inside a class can add no link between classes.

Defined results: a text of fewer words than ``width`` has one shingle, its whole word sequence; null or wordless texts
have an empty set and stay alone; repeated rows are equal sets; every input row gives one row; a null id never names a
class that has another id. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, SPACE, bounded_broadcast, components, materialize, mix, partitions, prefix_hash, runs, span_hash, text_bytes, text_key

WIDTH, PERCENT = 5, 75
#: Words of 64 bits in a set's signature; rounds in which groups of an element meet their neighbours in a shuffled order.
SIGNATURE, ROUNDS = 16, 2
_STEP = np.random.default_rng(31).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(b: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's bytes."""
    starts, ends = runs(~SPACE[b])
    if not len(starts):
        return np.zeros(0, np.uint64)
    w = span_hash(prefix_hash(LOWER[b]), starts, ends)
    if len(w) < width:
        return mix((w * _STEP[: len(w)]).sum(keepdims=True) + np.uint64(len(w)))
    h = np.zeros(len(w) - width + 1, np.uint64)
    for i in range(width):
        h += w[i: i + len(h)] * _STEP[i]
    return np.unique(mix(h))


def _least_common(n: Column | int, percent: int):
    """Elements that a set of n shares with any set that it links to, at least."""
    return (n * percent + 99) // 100


def _slack(n: int) -> int:
    return 1 + n // 16


def _heads(batches: Iterator[pa.RecordBatch], width: int, percent: int, heads: bool) -> Iterator[pa.RecordBatch]:
    """``id, n, key`` (digest of the set) and ``sum``; with ``heads``, ``key, head`` of sets that the task has not met before."""
    seen: set[bytes] = set()
    for batch in batches:
        sizes, keys, firsts = [], [], []
        for b in text_bytes(batch.column(1)):
            s = shingles(b, width)
            key = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
            if heads:
                if key is None or key in seen:
                    continue
                seen.add(key)
                firsts.append(s[: len(s) - _least_common(len(s), percent) + _slack(len(s))].view(np.int64))
            sizes.append(len(s))
            keys.append(key)
        if len(seen) > 500_000:  # forgetting only sends a set again
            seen.clear()
        k, n = pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())
        yield pa.RecordBatch.from_arrays([k, n, pa.array(firsts, pa.list_(pa.int64()))], ["key", "n", "head"]) if heads else pa.RecordBatch.from_arrays([batch.column(0), n, k, batch.column(2)], ["id", "n", "key", "sum"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """``key, set`` of the rows whose text has the set of that key: rows of one id may have other texts."""
    for batch in batches:
        sets = [(key, shingles(b, width)) for key, b in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True)]
        sets = [(key, s.view(np.int64)) for key, s in sets if xxhash.xxh3_128_digest(s.tobytes()) == key]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in sets], pa.binary()), pa.array([x[1] for x in sets], pa.list_(pa.int64())), pa.array([_signature(x[1]) for x in sets], pa.list_(pa.int64()))], ["key", "set", "sig"])


def _signature(s: np.ndarray) -> np.ndarray:
    """Bits that the elements set: two sets differ in at least as many elements as their signatures do in bits."""
    bits = np.zeros(64 * SIGNATURE, dtype=np.uint8)
    bits[(s.view(np.uint64) >> np.uint64(17)) % np.uint64(64 * SIGNATURE)] = 1
    return np.packbits(bits).view(np.int64)


def _prefixes(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """From ``key, n, shared`` (frequency and hash of the elements that other sets have too): the prefix."""
    for batch in batches:
        cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        out = []
        for key, n, shared in zip(cols["key"].to_pylist(), cols["n"].to_pylist(), cols["shared"], strict=True):
            values = shared.values
            df, h = values.field(0).to_numpy(), values.field(1).to_numpy()
            alone = n - len(h)
            take = n - _least_common(n, percent) + 1 - alone
            if take > 0:
                order = np.lexsort((h, df))[:take]
                first = h[order]
                own = xxhash.xxh3_128_digest(np.int64([n, alone]).tobytes() + first.tobytes())
                out.append((key, n, alone, own, first))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)], ["key", "n", "alone", "prefix_key", "prefix"])


def _could(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of sizes ``n`` that first meet at these ranks, with these signatures, can link at all."""
    need = F.ceil((x["n"] + y["n"]) * percent / (100 + percent) - 1e-9)
    differ = sum((F.bit_count(F.get(x["sig"], F.lit(i)).bitwiseXOR(F.get(y["sig"], F.lit(i)))) for i in range(SIGNATURE)), F.lit(0))
    return ((F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent) & (F.least(x["n"] - x["rank"], y["n"] - y["rank"]) >= need)
            & (F.coalesce(differ, F.lit(0)) <= x["n"] + y["n"] - 2 * need))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` (keys of different sets) that link."""
    a, b = sets.select(F.col("key").alias("a"), F.col("set").alias("sa")), sets.select(F.col("key").alias("b"), F.col("set").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(b, "b").join(a, "a").where(both * 100 >= (F.size("sa") + F.size("sb") - both) * percent).select("a", "b")


def join_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(id, n, component, sum, first)`` for every input row, and the links found: ``(a, b)`` keys of sets. ``sum`` is
    the text's ``text_key``; ``first`` is true for rows with the smallest id and sum of their class, null ids last.

    Links join classes completely; pairs inside a class beyond those that joined it are not listed."""
    spark, k = docs.sparkSession, partitions(docs.sparkSession)
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    made = materialize(two.withColumn("sum", text_key(F.col("text"))).mapInArrow(lambda it: _heads(it, width, percent, False), f"id {kind}, n long, key binary, sum binary"), "sets")
    # Step 2: elements of the hash-order prefixes that more than one set has.
    heads = two.mapInArrow(lambda it: _heads(it, width, percent, True), "key binary, n long, head array<long>")
    heads = heads.select(F.xxhash64("key").alias("set"), "n", F.explode("head").alias("e")).repartition(k, "e")
    meet = Window.partitionBy("e")
    met = heads.withColumns({"lo": F.min("set").over(meet), "hi": F.max("set").over(meet)}).where("lo <> hi").select("set", "n", "e")
    live = met.groupBy("set", "n").agg(F.approx_count_distinct("e").alias("x"), F.count("*").alias("c")).where("c >= 1 + n div 16").select("set")
    firsts = made.where("n > 0").groupBy("key", "n").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))).alias("first"))
    firsts = firsts.withColumn("set", F.xxhash64("key")).join(live, "set", "left_semi").select("key", "n", F.col("first.id").alias("id"))
    firsts = materialize(firsts, "live")
    chosen = bounded_broadcast(firsts.select("key", F.col("id").alias("of")), firsts.count(), 64)
    text = two.join(chosen, F.col("id").eqNullSafe(F.col("of"))).select("key", "text")
    sets = text.mapInArrow(lambda it: _sets(it, width), "key binary, set array<long>, sig array<long>")
    repeated = not made.groupBy("id").count().where("count > 1").isEmpty()
    sets = materialize(sets.dropDuplicates(["key"]) if repeated else sets, "live_sets")
    # Steps 3 and 4.
    elements = sets.select("key", F.size("set").cast("long").alias("n"), F.explode("set").alias("e")).repartition(k, "e")
    elements = elements.withColumn("df", F.count("*").over(Window.partitionBy("e"))).where("df > 1")
    shared = elements.groupBy("key", "n").agg(F.collect_list(F.struct("df", "e")).alias("shared"))
    units = materialize(shared.mapInArrow(lambda it: _prefixes(it, percent), "key binary, n long, alone long, prefix_key binary, prefix array<long>"), "prefixes")
    groups = materialize(units.groupBy("prefix_key").agg(F.min("key").alias("g"), F.count("*").alias("size"), F.first("n").alias("n"), F.first("alone").alias("alone"), F.first("prefix").alias("prefix")), "groups")
    members = units.join(groups.select("prefix_key", "g"), "prefix_key").select("g", "key")
    at = groups.select("g", "n", "alone", F.posexplode("prefix").alias("i", "e"))
    # Step 5.
    own = F.struct((F.col("alone") / F.col("n")).alias("own"), F.col("g").alias("g"))
    star = at.join(at.groupBy("e").agg(F.min(own)["g"].alias("first")), "e").where("g <> first").select(F.col("first").alias("a"), F.col("g").alias("b")).distinct()
    links = materialize(_verified(star.union(members.where("g <> key").select(F.col("g").alias("a"), F.col("key").alias("b"))), sets, percent), "links")
    classes = components(links, "a", "b")
    at = at.select("g", "n", "e", (F.col("alone") + F.col("i")).alias("rank"))

    def units() -> DataFrame:
        """The members of a group that are in one class, by their smallest."""
        named = members.join(classes, F.col("key") == F.col("node"), "left").select("g", "key", F.coalesce("component", "key").alias("class"))
        return named.groupBy("g", "class").agg(F.min("key").alias("key"), F.count("*").alias("size"))

    sig = sets.select("key", "sig")
    for turn in range(ROUNDS):
        mixed = at.join(units(), "g")
        several = mixed.groupBy("e").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("e")
        mixed = mixed.join(several, "e").join(sig, "key").select("e", F.struct("key", "n", "rank", "class", "sig").alias("x"))
        shuffled = Window.partitionBy("e").orderBy(F.xxhash64(F.lit(turn), "e", "x.key"), "x.key")
        beside = mixed.select("x", F.lag("x", 1).over(shuffled).alias("y1"), F.lag("x", 2).over(shuffled).alias("y2"))
        beside = beside.select("x", F.explode(F.array("y1", "y2")).alias("y")).where("x.class <> y.class")
        beside = beside.where(_could(F.col("x"), F.col("y"), percent)).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
        links = links.union(materialize(_verified(beside, sets, percent), "links"))
        classes = components(links, "a", "b")
    # Step 6.
    all_units = members.join(classes, F.col("key") == F.col("node"), "left").select("g", "key", F.coalesce("component", "key").alias("class"))
    all_units = materialize(all_units, "units")
    # A unit of one has its set's signature, which bounds what it can share; larger units have none.
    alone = units().where("size = 1").join(sig, "key").select("g", "class", "sig")
    at = at.join(all_units.select("g", "class").distinct(), "g")
    largest = at.groupBy("e", "class").agg(F.count("*").alias("c")).groupBy("e").agg(F.max(F.struct("c", "class")).alias("m"), F.count("*").alias("classes")).where("classes > 1")
    at = materialize(at.join(largest.select("e", F.col("m.class").alias("most")), "e").join(alone, ["g", "class"], "left"), "cross")
    unit = F.struct("g", "n", "rank", "class", "sig")
    x = at.where("class <> most").select("e", unit.alias("x"))
    y = at.select("e", unit.alias("y"), (F.col("class") == F.col("most")).alias("in_most"))
    meet = (F.col("x.class") != F.col("y.class")) & (F.col("in_most") | (F.col("x.class") < F.col("y.class")))
    cross = x.join(y, "e").where(meet & _could(F.col("x"), F.col("y"), percent))
    cross = cross.select(F.col("x.g").alias("gx"), F.col("x.class").alias("cx"), F.col("y.g").alias("gy"), F.col("y.class").alias("cy"))
    cross = cross.select("gx", "cx", "gy", "cy").distinct()
    one = lambda g, c, out: all_units.select(F.col("g").alias(g), F.col("class").alias(c), F.col("key").alias(out))
    rest = cross.join(one("gx", "cx", "a"), ["gx", "cx"]).join(one("gy", "cy", "b"), ["gy", "cy"]).select("a", "b")
    late = materialize(_verified(rest, sets, percent), "late_links")
    links = links.union(late)
    last = components(links, "a", "b")
    named = made.join(last, F.col("key") == F.col("node"), "left").select("id", "n", "sum", F.coalesce("component", "key").alias("class"))
    row = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("sum").alias("sum"))
    names = named.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("least"), F.min(row).alias("one"))
    named, names = named.alias("d"), names.alias("s")
    first = F.col("one").isNull() | (F.col("id").eqNullSafe(F.col("one.id")) & (F.col("sum") == F.col("one.sum")))
    return named.join(names, F.col("d.class") == F.col("s.class"), "left").select("id", "n", F.coalesce("least", "id").alias("component"), "sum", first.alias("first")), links
