"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every document of a source gets a place in a hash-shuffled order of that source. Its virtual finish time is the
source's words up to and including it, divided by the source's target. All documents are then served in the order
of that time until the total budget is spent, so that at any moment each source has had words in proportion to its
target. A source whose target is above its size is served again in the same order, at most ``max_repeats`` times.

Running sums never sort a source in one task: documents are dealt to even ranges of their hash, ranges are summed
first, and only the table of range sums (ranges x sources rows) is put in order.

Defined results: null text has size 0; a null source is a source of its own, last in order; documents of size 0
take no words; repeated rows, rows of one id and rows without id have a place each, and equal ones differ only in their
number; an empty table gives an empty mix.
Other columns are only carried, inside the struct ``row``, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, materialize, partitions, text_key

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in code-point order (null last) take ``weights`` in turn and share ``share`` times all words. A target
    stops at ``max_repeats`` times its source's size; what is left goes to the others by weight. That is the level
    ``l`` with sum(min(cap, l * weight)) = budget: sources sorted by cap / weight, each
    tried as the first uncapped; of the levels at which that one is uncapped, the highest leaves no cap unused.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")  # one row a source
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    per = per.withColumn("w", w).withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size"))
    ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before, rest = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = per.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every))
    per = per.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))).over(every)
    return per.select("source", "source_size", F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("w")).alias("target"))


#: Copies that one row is unfolded into by one task.
BLOCK = 4096
GROUP = ["id", "source", "size", "key"]


def _entries(narrow: DataFrame, ranges: int) -> DataFrame:
    """An entry for each row of ``id, source, size, key`` with its number ``copy`` among equal rows, its place ``h`` in the
    shuffled order and its range ``r`` of places. Equal rows are counted first and unfolded in blocks, so a hot group is spread."""
    group = narrow.groupBy(*GROUP).agg(F.count("*").alias("copies"))
    own = ["id", "source", "size"]
    shared = group.groupBy(*own).agg(F.sum("copies").alias("n")).where("n > 1").select(*[F.col(c).alias(f"of_{c}") for c in own])
    same = F.col("id").eqNullSafe(F.col("of_id")) & F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size"))
    group = group.join(shared.withColumn("shared", F.lit(True)), same, "left").select(*GROUP, "copies", F.coalesce("shared", F.lit(False)).alias("shared"))
    blocks = group.where("copies > 1").select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / BLOCK).cast("int"))).alias("block")).repartition(*GROUP, "block")
    copy = F.sequence(F.col("block") * BLOCK + 1, F.least(F.col("copies"), (F.col("block") + 1) * BLOCK).cast("int"))
    each = group.where("copies = 1").withColumn("copy", F.lit(1)).unionByName(blocks.withColumn("copy", F.explode(copy)).drop("block"))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    name = F.when(F.col("shared"), F.concat_ws(":", name, F.hex("key"), "copy")).otherwise(name)
    each = each.withColumn("h", F.md5(name.cast("binary"))).drop("shared")
    return each.withColumn("r", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") * ranges / 2.0 ** 32).cast("int"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``copy``: the number of a row among the rows of its group, 1 if ``copies`` is 1. No group meets in one task: rows
    are numbered within the task that wrote them, and the tasks' counts are added up."""
    twice = materialize(rows.where("copies > 1").withColumn("u", F.monotonically_increasing_id()), "mix_repeats").withColumn("part", F.shiftright("u", 33))
    inside = Window.partitionBy("part", *GROUP).orderBy("u")
    before = Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = twice.groupBy("part", *GROUP).agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = parts.select(*[F.col(c).alias(f"of_{c}") for c in ["part", *GROUP]], "before")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ["part", *GROUP]]
    number = twice.select("u", "part", *GROUP, F.row_number().over(inside).alias("k")).join(parts, same).select(F.col("u").alias("at"), (F.col("k") + F.col("before")).cast("int").alias("copy"))
    twice = twice.join(number, F.col("u") == F.col("at")).drop("u", "part", "at")
    return rows.where("copies = 1").withColumn("copy", F.lit(1)).unionByName(twice)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2, keep_text: bool = True) -> DataFrame:
    """For every input row ``mix_size, mix_source_size, mix_target, mix_times`` (how often the mix serves it) and
    ``mix_finish`` (its first virtual finish time), with the row itself as a struct ``row`` if ``keep_text``, else with
    ``mix_id, mix_source``. ``mix_size * mix_times`` words enter the mix."""
    n = partitions(docs.sparkSession)
    own = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), text_key(F.col(text_col)).alias("key")]
    entries = materialize(_entries(docs.select(*own), n), "mix_sizes")
    words = F.sum("size")
    ranges = entries.groupBy("source", "r").agg(words.alias("words"))
    ahead = Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    targets = source_targets(ranges.select("source", F.col("words").alias("size")), weights, share, max_repeats).withColumnRenamed("source", "of")
    ranges = ranges.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(F.col("source").alias("of"), F.col("r").alias("in"), "ahead", "source_size", "target")
    inside = Window.partitionBy("source", "r").orderBy("h", "id", "size", "key", "copy").rowsBetween(Window.unboundedPreceding, 0)
    placed = entries.withColumn("upto", words.over(inside))
    placed = placed.join(ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("r") == F.col("in")))
    placed = materialize(placed.select(*GROUP, "copies", "copy", "h", "source_size", "target", (F.col("upto") + F.col("ahead")).alias("upto")), "mix_placed")
    # One entry for each time a document may be served, dealt to slots of finish time.
    served = placed.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("turn"))
    served = served.withColumn("finish", (F.col("upto") + F.col("turn") * F.col("source_size")) / F.col("target"))
    served = served.withColumn("slot", F.floor(F.least("finish", F.lit(4.0)) * n).cast("int"))
    slots = served.groupBy("slot").agg(words.alias("words"))
    earlier = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # at most 4 n + 1 rows
    slots = slots.select("slot", "words", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("ahead"))
    budget = F.broadcast(entries.agg((F.least(F.lit(float(share)), F.lit(float(max_repeats))) * words).alias("budget")))
    slots = slots.crossJoin(budget)  # one row
    # Slots below the budget are served whole and those above it not at all; only the one where it ends is put in order.
    whole = served.join(F.broadcast(slots.where("ahead + words <= budget").select("slot")), "slot", "left_semi")
    cut = served.join(F.broadcast(slots.where("ahead <= budget AND ahead + words > budget").select("slot", "ahead", "budget")), "slot")
    by = Window.partitionBy("slot").orderBy("finish", "h", "id", "source", "turn", "size", "key", "copy").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("spent", F.col("ahead") + words.over(by)).where("spent <= budget")
    each = [*GROUP, "copy"]
    times = whole.select(*each).unionByName(cut.select(*each)).groupBy(*each).agg(F.count("*").alias("times"))
    t, p = times.alias("t"), placed.alias("p")
    entry = p.join(t, [F.col(f"p.{c}").eqNullSafe(F.col(f"t.{c}")) for c in each], "left").select(
        *[F.col(f"p.{c}").alias(f"mix_{c}") for c in each], F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("copies").alias("mix_copies"),
        (F.col("upto") / F.col("target")).alias("mix_finish"), F.coalesce(F.col("t.times"), F.lit(0)).cast("long").alias("mix_times"))
    if not keep_text:
        return entry.drop("mix_key", "mix_copy", "mix_copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *own)
    again = placed.where("copies > 1 AND copy = 1").select(*[F.col(c).alias(f"of_{c}") for c in GROUP], "copies")
    repeated = again.count()
    counted = rows.withColumn("copies", F.lit(1))
    if repeated:
        again = bounded_broadcast(again, repeated, 128)
        counted = rows.join(again, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in GROUP], "left").select("row", *GROUP, F.coalesce(again["copies"], F.lit(1)).alias("copies"))
        counted = _numbered(counted)
    else:
        counted = counted.withColumn("copy", F.lit(1))
    out = counted.join(entry, [F.col(c).eqNullSafe(F.col(f"mix_{c}")) for c in each])
    return out.select("row", "mix_size", "mix_source_size", "mix_target", "mix_finish", "mix_times")


def serve(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is served, in order of virtual finish time."""
    out = mixed.where("mix_times > 0").withColumn("mix_turn", F.explode(F.sequence(F.lit(0), F.col("mix_times").cast("int") - 1)))
    finish = F.col("mix_finish") + F.col("mix_turn") * F.col("mix_source_size") / F.col("mix_target")
    return out.withColumn("mix_finish", finish).repartitionByRange("mix_finish").sortWithinPartitions("mix_finish")
