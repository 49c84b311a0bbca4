"""Chat formatting as a forest of shared turns.

Conversations that begin with the same turns share them: all conversations form prefix trees, each turn of a tree is
written once, depth first, and every conversation's own part (a segment) carries the place of its first character in
the tree, the position ids (distance from the root along its own branch) and the intervals of the tree that it may
attend to, one for each ancestor segment; inside itself it is causal. A mask marks the text of assistant turns.

How: turns are gathered by conversation and each prefix gets a chained digest; identical conversations are one entry.
Entries are range-sorted by their digest path, which is depth-first order with shared prefixes side by side; so the
part that an entry shares with the forest is what it shares with its predecessor. Each partition is scanned twice as
a stream: once for its totals and last path, and, with what the partitions before it carry over (one row each), to
write segments. No tree is ever in one place.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts, ``<`` + backslashes + ``|`` gets one more backslash, so no
control string can appear and unescaping is exact; roles also escape backslashes and line ends. Units are code points
of the formatted text; with an ``encode`` function each piece (header, text, end) is tokenised on its own and units
are its ids, so shared turns share ids.

Defined results: null text or role is empty; turns are ordered by (turn, role, text), null turn first, ties and
repeated rows kept; rows without a conversation id are conversations of one turn each, as nothing says that they
belong together; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, partitions

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_MARK, _MARKED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def pieces(role: str, text: str) -> tuple[str, str, str]:
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        line, stop = formatted.index("\n", at), formatted.index(END, at)
        turns.append((unescape_role(formatted[at + len(START): line]), unescape(formatted[line + 1: stop])))
        at = stop + len(END) + 1
    return turns


def _turn_digest(before: bytes, role: str, text: str) -> bytes:
    return hashlib.blake2b(before + f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def gather(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turns, path``: a row for each conversation; path chains 16-byte digests, one for each prefix."""
    c = F.col(conv)
    alone = F.when(c.isNull(), F.uuid())
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = turns.select(c.alias("conv"), alone.alias("alone"), one.alias("one")).groupBy("conv", "alone").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    rows = rows.select("conv", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    @F.pandas_udf("binary")
    def path(turns: pd.Series) -> pd.Series:
        out = []
        for conversation in turns:
            before, chain = b"", []
            for t in conversation:
                before = _turn_digest(before, t["role"], t["text"])
                chain.append(before)
            out.append(b"".join(chain))
        return pd.Series(out, dtype=object)

    return rows.withColumn("path", path("turns"))


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // 16
    lo, hi = 0, n  # chained digests: equal up to some place, different after it
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[16 * mid - 16: 16 * mid] == b[16 * mid - 16: 16 * mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class _Forest:
    """What a depth-first scan remembers: the last path, and for each of its turns its length, the segment that wrote
    it and its place in the tree; and the tree's end so far."""

    def __init__(self, path: bytes = b"", lengths=(), segments=(), starts=(), end: int = 0):
        self.path, self.lengths, self.segments, self.starts, self.end = path, list(lengths), list(segments), list(starts), end

    def add(self, path: bytes, lengths: list[int]) -> tuple[int, int, list[tuple[int, int]]]:
        """Turns shared with the forest, place of the new segment, and its ancestors' intervals."""
        k = _shared(self.path, path)
        if k == 0:
            self.end = 0
        start = self.end
        attend: list[tuple[int, int]] = []
        for i in range(k):
            stop = self.starts[i] + self.lengths[i]
            if attend and attend[-1][0] == self.segments[i]:
                attend[-1] = (attend[-1][0], stop)
            else:
                attend.append((self.segments[i], stop))
        del self.lengths[k:], self.segments[k:], self.starts[k:]
        for n in lengths[k:]:
            self.lengths.append(n)
            self.segments.append(start)
            self.starts.append(self.end)
            self.end += n
        self.path = path
        return k, start, attend


def _lengths(turns, encode) -> list[int]:
    if encode is None:
        return [sum(map(len, pieces(t["role"], t["text"]))) for t in turns]
    return [sum(len(encode(p)) for p in pieces(t["role"], t["text"])) for t in turns]


def _summaries(batches: Iterator[pd.DataFrame], encode) -> Iterator[pd.DataFrame]:
    """One row for a partition: its first path, and the path and tree that it leaves behind if nothing came before it."""
    part = first = last = None
    forest = _Forest()
    whole = True  # still in the tree of the first entry
    for batch in batches:
        for r in batch.itertuples(index=False):
            lengths = _lengths(r.turns, encode)
            if first is None:
                part, first = r.part, (r.path, lengths)
            k, _, _ = forest.add(r.path, lengths)
            whole = whole and (k > 0 or r.path is first[0])
            last = r.path
    if first is not None:
        yield pd.DataFrame({"part": [part], "first": [first[0]], "first_lengths": [first[1]], "whole": [whole], "last": [last], "lengths": [forest.lengths], "segments": [forest.segments], "starts": [forest.starts], "end": [forest.end]})


SUMMARY = "part int, first binary, first_lengths array<long>, whole boolean, last binary, lengths array<long>, segments array<long>, starts array<long>, end long"


def _carry(parts: pd.DataFrame) -> pd.DataFrame:
    """The forest as each partition finds it. One row for each partition comes in and goes out."""
    out, forest = [], _Forest()
    for r in parts.sort_values("part").itertuples(index=False):
        out.append((r.part, forest.path, list(forest.lengths), list(forest.segments), list(forest.starts), forest.end))
        last, lengths, segments, starts = r.last, list(r.lengths), list(r.segments), list(r.starts)
        k = _shared(forest.path, r.first)  # turns of the first entry that were there before
        if not r.whole or k == 0:
            forest = _Forest(last, lengths, segments, starts, r.end)
            continue
        # The partition stays in the tree it was handed: its own places shift by what was there, less what is shared.
        known = sum(forest.lengths[:k])
        shift = forest.end - known
        keep = min(k, _shared(r.first, last))
        move = lambda x: x + shift if x >= known else forest.end  # noqa: E731  the first entry's segment begins at its own part
        forest = _Forest(last, lengths, forest.segments[:keep] + [move(x) for x in segments[keep:]], forest.starts[:keep] + [x + shift for x in starts[keep:]], r.end + shift)
    return pd.DataFrame(out, columns=["part", "path", "lengths", "segments", "starts", "end"])


def _segments(batches: Iterator[pd.DataFrame], encode, carried: dict) -> Iterator[pd.DataFrame]:
    forest = None
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            if forest is None:
                forest = _Forest(*carried[int(r.part)])
            lengths = _lengths(r.turns, encode)
            k, start, attend = forest.add(r.path, lengths)
            position, at, text, ids, loss = sum(lengths[:k]), 0, [], [], []
            for t in r.turns[k:]:
                for i, p in enumerate(pieces(t["role"], t["text"])):
                    got = encode(p) if encode else p
                    if i == 1 and t["role"] == LOSS_ROLE and len(got):
                        loss.append((at, at + len(got)))
                    at += len(got)
                    text.append(p)
                    ids.extend(got if encode else ())
            rows.append((r.path, r.path[:16].hex(), start, at, position, k, "".join(text), ids if encode else None, [{"start": a, "stop": b} for a, b in loss], [{"segment": a, "stop": b} for a, b in attend]))
        yield pd.DataFrame(rows, columns=["path", "tree", "start", "length", "position", "shared_turns", "text", "ids", "loss", "attend"])


SEGMENT = ("path binary, tree string, start long, length long, position long, shared_turns int, text string, ids array<int>, "
           "loss array<struct<start:long,stop:long>>, attend array<struct<segment:long,stop:long>>")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 encode: Callable[[str], list[int]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Segments and members.

    Segments: ``tree``; ``start, length`` in the tree's depth-first sequence; ``position``: position id of the first
    unit, the others follow; ``text`` (and ``ids``); ``loss``: intervals within the segment; ``attend``: of each ancestor
    segment the units [segment, stop) of the tree. Members: ``conv, n_turns, tree, start``: the segment that ends it.
    """
    spark = turns.sparkSession
    rows = materialize(gather(turns, conv, turn, role, text), "chats")
    # Identical conversations: one entry. Its turns are taken from the first of them.
    entries = rows.groupBy("path").agg(F.first("turns").alias("turns"))
    # Sorted and written once: later scans see the same partitions whatever is lost.
    entries = entries.repartitionByRange(partitions(spark), "path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id()).select("part", "path", "turns").checkpoint()
    parts = entries.mapInPandas(lambda it: _summaries(it, encode), SUMMARY)
    # A row for each partition, with one conversation's path: the only thing that passes through the driver.
    carried = {int(r.part): (r.path, r.lengths, r.segments, r.starts, r.end) for r in _carry(parts.toPandas()).itertuples(index=False)}
    segments = materialize(entries.mapInPandas(lambda it: _segments(it, encode, carried), SEGMENT), "segments")
    ends = segments.select("path", "tree", "start")
    members = rows.select("conv", F.size("turns").cast("long").alias("n_turns"), "path").join(ends, "path").drop("path")
    return segments.drop("path"), members


def read_back(segments: DataFrame) -> DataFrame:
    """``tree, start, text, loss``: the whole formatted conversation that ends in each segment, put together from the
    intervals it attends to and itself; loss: the masked parts in order (units are code points)."""
    own = F.struct(F.col("start").alias("segment"), (F.col("start") + F.col("length")).alias("stop"))
    need = segments.select("tree", F.col("start").alias("of"), F.explode(F.array_append("attend", own)).alias("x")).select("tree", "of", F.col("x.segment").alias("start"), F.col("x.stop").alias("stop"))
    n = (F.col("stop") - F.col("start")).cast("int")
    part = need.join(segments.select("tree", "start", "text", "loss"), ["tree", "start"]).withColumn("n", n)
    inside = F.filter("loss", lambda x: x["stop"] <= F.col("n"))
    masked = F.transform(inside, lambda x: F.substring(F.col("text"), x["start"].cast("int") + 1, (x["stop"] - x["start"]).cast("int")))
    part = part.select("tree", "of", F.struct("start", F.substring("text", F.lit(1), F.col("n")).alias("text"), masked.alias("loss")).alias("p"))
    whole = part.groupBy("tree", "of").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return whole.select("tree", F.col("of").alias("start"), F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"), F.flatten(F.transform("p", lambda x: x["loss"])).alias("loss"))


DIGESTS = T.StructType([T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


@F.pandas_udf(DIGESTS)
def digests(text: pd.Series, loss: pd.Series) -> pd.DataFrame:
    out = []
    for t, masked in zip(text, loss, strict=True):
        turns = parse(t)
        said = "".join(unescape(x) for x in masked)
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(t)))
    return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
