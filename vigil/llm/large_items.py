"""Token sequences packed by large-item matching, planned on the histogram of lengths.

Tasks tokenise the documents, end each with one id, and cut what is longer than a sequence. A packing depends on lengths
alone, and there are at most ``sequence_tokens`` of them, so the driver plans on their counts, whatever the corpus holds:
a piece above a third of the capacity is large, and a sequence holds at most two; going down, each large length is matched
with the longest that still fits beside it. Smaller lengths then go, longest first, into the tightest gap that takes them,
and open new sequences only when no gap does. Equal lengths are planned together, so the plan is a list of runs: "the next
``bins * copies`` pieces of this length go to the sequences from ``base`` on, ``copies`` in each, from place ``at``".

A piece finds its run by its number among the pieces of its length: its number within the task that wrote it, plus the
pieces of that length in earlier tasks. No group of equal pieces meets in one task, and only counts are shuffled.

The plan is small: a range of sequences is split at most twice for a length and is filled whole at most 11 times, as that
more than halves its gap; so it has fewer than ``11 * 5 * sequence_tokens`` runs at any corpus size, and may be broadcast.

Defined results: null and empty texts are one piece that holds the closing id; repeated rows, ties and rows without id are
packed as often as they come; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, materialize

SEQUENCE_TOKENS = 2048
#: Units whose ids a task remembers, some 150 MB; it starts with none and forgets them when it ends.
UNITS_KEPT = 800_000
#: Characters of text that are looked at together; a longer document comes in parts.
PART_CHARS = 1 << 20
#: Units that one call of the tokenizer encodes, put apart by a token of their own.
CALL_UNITS = 4096
#: Fixed value: how a byte-level tokenizer cuts texts before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
APART = "\x00\x00apart\x00\x00"
#: Marks that are no letter, number or space to the pattern; and the letters behind which they are cut off.
PUNCTUATION, LAST_LATIN = ".,;:!?", "\u024f"


def byte_ranks(tokenizer: str) -> dict[bytes, int] | None:
    """The ranks of a byte-level BPE whose ids are in the order of its merges, so that merging by rank is the same as merging
    by its list; None for any other tokenizer."""
    t = json.loads(tokenizer)
    model, cut = t["model"], t["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or t["normalizer"] or t["post_processor"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that are written as themselves; the others follow from 256 on
    rest = [b for b in range(256) if b not in own]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocab = model["vocab"]
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
    if any(x >= y for x, y in zip([-1, *merged], merged, strict=False)) or not set(byte) <= set(vocab) or max(vocab[c] for c in byte) >= min(merged):
        return None
    made = {*merged, *(vocab[c] for c in byte)}
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if i in made}


class Units:
    """Codes of the units of texts, and the ids that each code stands for.

    The byte-level pattern never joins what stands before a blank with the blank and the non-space after it, so a text may
    be encoded unit by unit: its first word as it is, each further word with its blank. ``behind`` has the codes of words
    behind a blank, ``whole`` those of units as they are. Units of Latin letters and signs are merged by rank where that is
    the same (``byte_ranks``), as it takes half the time; all others go through the tokenizer itself.
    """

    cut = re.compile(r"(?= \S)")
    safe = re.compile(r" (?=\S)")

    def __init__(self, tokenizer: str, ranks: dict[bytes, int] | None = None):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core
        self.own = Tokenizer.from_str(tokenizer)
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        self.by_rank = None
        if ranks:
            import tiktoken

            self.apart = max(ranks.values()) + 1 + len(self.special)
            self.by_rank = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={APART: self.apart})
        self.forget()

    def forget(self) -> None:
        self.behind: dict[str, int] = {}
        self.whole: dict[str, int] = {}
        self.ids, self.starts = array("I"), array("q", [0, 0])  # code 0 stands for nothing

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> range:
        """The codes of new units, whose ids follow each other in ``ids``."""
        first, at = len(self.starts) - 1, len(self.ids)
        self.ids.frombytes(ids.astype(np.uint32).tobytes())
        self.starts.frombytes((at + np.cumsum(lengths)).astype(np.int64).tobytes())
        return range(first, len(self.starts) - 1)

    def _slow(self, units: list[str]) -> range:
        each = [e.ids for e in self.own.encode_batch_fast(units, add_special_tokens=False)]
        return self._keep(np.array([i for ids in each for i in ids], np.uint32), np.array([len(ids) for ids in each], np.int64))

    def _fast(self, units: list[str]) -> range:
        ids = np.array(self.by_rank.encode(APART.join(units), allowed_special={APART}), dtype=np.int64)
        ends = np.append(np.flatnonzero(ids == self.apart), len(ids))
        return self._keep(ids[ids != self.apart], np.diff(ends, prepend=-1) - 1)

    def _learn(self, new: list[str], known: dict[str, int], blank: str) -> None:
        by_rank = (lambda t: max(t) <= LAST_LATIN and APART not in t and not any(x in t for x in self.special)) if self.by_rank else lambda t: False
        for i in range(0, len(new), CALL_UNITS):
            some = new[i: i + CALL_UNITS]
            # Mostly all units may be merged by rank, which one look at all of them tells.
            if self.by_rank and by_rank("".join(some)):
                fast, slow = some, []
            else:
                fast = [u for u in some if by_rank(blank + u)]
                kept = set(fast)
                slow = [u for u in some if u not in kept]
            if fast:
                known.update(zip(fast, self._fast([blank + u for u in fast]), strict=True))
            if slow:
                known.update(zip(slow, self._slow([blank + u for u in slow]), strict=True))

    def _learn_behind(self, new: list[str]) -> None:
        """Words are learnt without the punctuation behind their last letter, which starts a token of its own."""
        cores = [w.rstrip(PUNCTUATION) for w in new]
        ends = [bool(c) and len(c) < len(w) and c[-1] <= LAST_LATIN and c[-1].isalpha() for w, c in zip(new, cores, strict=True)]
        known = self.behind
        self._learn([w for w in {c if e else w for w, c, e in zip(new, cores, ends, strict=True)} if w not in known], known, " ")
        tails = [w[len(c):] for w, c, e in zip(new, cores, ends, strict=True) if e]
        self._learn([t for t in set(tails) if t not in self.whole], self.whole, "")
        pairs = np.array([(known[c], self.whole[t]) for c, t in zip((c for c, e in zip(cores, ends, strict=True) if e), tails, strict=True)], dtype=np.int64).reshape(-1, 2)
        at = np.frombuffer(self.starts, dtype=np.int64)
        lengths = (at[pairs + 1] - at[pairs]).sum(axis=1)
        del at  # the array grows next
        known.update(zip((w for w, e in zip(new, ends, strict=True) if e), self._keep(self._gather(pairs.ravel())[0], lengths), strict=True))

    def _behind(self, words: list[str]) -> np.ndarray:
        """The codes of words behind a blank; -1 for what starts with white space or is empty: its text is odd."""
        found = list(map(self.behind.get, words))
        if None in found:
            new = [w for w, c in zip(words, found, strict=True) if c is None]
            odd = {w for w in new if not w or w[0].isspace()}
            self._learn_behind([w for w in new if w not in odd])
            self.behind.update(dict.fromkeys(odd, -1))
            found = [self.behind[w] if c is None else c for w, c in zip(words, found, strict=True)]
        return np.array(found, dtype=np.int64)

    def _whole(self, units: list[str]) -> list[int]:
        """The codes of units as they are; the empty one is 0."""
        self._learn(sorted({u for u in units if u and u not in self.whole}), self.whole, "")
        return [self.whole[u] if u else 0 for u in units]

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``codes``, one after another, and how many each has."""
        at = np.frombuffer(self.starts, dtype=np.int64)
        ids = np.frombuffer(self.ids, dtype=np.uint32) if self.ids else np.zeros(0, np.uint32)
        n = at[codes + 1] - at[codes]
        return ids[np.repeat(at[codes] - np.cumsum(n) + n, n) + np.arange(n.sum())], n

    def _chunk(self, texts: list[str], starts: bool = True) -> list[np.ndarray]:
        """The ids of each text; unless it ``starts``, its first word is behind a blank that has been left out."""
        if len(self.behind) + len(self.whole) > UNITS_KEPT:
            self.forget()
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words, edge = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
        place, different = words.indices.to_numpy(), words.dictionary.to_pylist()
        codes = self._behind(different)[place]
        if starts:
            codes[edge[:-1]] = self._whole([different[i] for i in place[edge[:-1]].tolist()])
        odd = np.unique(np.searchsorted(edge, np.flatnonzero(codes < 0), "right") - 1).tolist()
        ids, n = self._gather(np.maximum(codes, 0))
        at = np.concatenate(([0], np.cumsum(n)))[edge].tolist()
        out = [ids[a:b] for a, b in zip(at, at[1:], strict=False)]
        for i in odd:
            units = self.cut.split(texts[i] if starts else " " + texts[i])
            out[i] = self._gather(np.array(self._whole(units), dtype=np.int64))[0]
        return out

    def _parts(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a long text by parts that end before a blank and a non-space."""
        at = 0
        while len(text) - at > PART_CHARS and (m := self.safe.search(text, at + PART_CHARS)):
            yield self._chunk([text[at + (at > 0): m.start()]], at == 0)[0]
            at = m.start()
        yield self._chunk([text[at + (at > 0):]], at == 0)[0]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        i = 0
        while i < len(texts):
            if len(texts[i]) > PART_CHARS:
                yield np.concatenate(list(self._parts(texts[i])))
                i += 1
                continue
            j, n = i, 0
            while j < len(texts) and len(texts[j]) + n <= PART_CHARS:
                n += len(texts[j])
                j += 1
            yield from self._chunk(texts[i:j])
            i = j


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, ranks: dict[bytes, int] | None, most: int, end: int, width: int) -> Iterator[pa.RecordBatch]:
    units, task, seen = Units(tokenizer, ranks), TaskContext.get().partitionId(), [0] * (most + 1)
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, 512)
            at += part.num_rows
            key, piece, start, length, number, crc, body, doc = [], [], [], [], [], [], [], 0
            for doc, ids in enumerate(units.encode([t or "" for t in part.column(1).to_pylist()])):
                ids = np.append(ids, np.uint32(end))
                cuts = [0, *range(len(ids) % most or min(most, len(ids)), len(ids) + 1, most)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    own = ids[a:b]
                    key.append(doc)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    number.append(seen[b - a])
                    seen[b - a] += 1
                    crc.append(zlib.crc32(own.astype("<u4").tobytes()))
                    body.append(own.astype(f"<u{width}").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(key, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                 pa.array([task] * len(key), pa.int32()), pa.array(number, pa.int64()), pa.array(crc, pa.int64()), pa.array(body, pa.binary())],
                ["id", "piece", "start", "length", "task", "number", "ids_crc32", "ids"])


def plan(counts: dict[int, int], most: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first, bins, copies, base, at)`` for ``counts`` pieces of each length (1 to ``most``)."""
    left, out, done = dict(counts), [], dict.fromkeys(counts, 0)
    bins = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # ranges of sequences (first, number) by their free space
    sizes: list[int] = []  # those free spaces, ascending

    def free(gap: int, base: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((base, n))

    def put(length: int, n: int, copies: int, base: int, at: int) -> None:
        out.append((length, done[length], n, copies, base, at))
        done[length] += n * copies
        left[length] -= n * copies

    large = sorted(n for n in left if 3 * n > most and left[n])  # ascending
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        fits = bisect_left(large, min(most - a, a) + 1) - 1  # the longest that fits beside a
        if fits >= 0 and large[fits] == a and left[a] < 2:
            fits -= 1
        while fits >= 0 and not left[large[fits]]:
            large.pop(fits)
            fits -= 1
        b = large[fits] if fits >= 0 else 0
        n = left[a] // 2 if b == a else min(left[a], left[b]) if b else left[a]
        put(a, n, 2 if b == a else 1, bins, 0)
        if b and b != a:
            put(b, n, 1, bins, a)
        free(most - a - b, bins, n)
        bins += n

    for s in sorted((n for n in left if 3 * n <= most), reverse=True):
        while left[s]:
            i = bisect_left(sizes, s)
            if i == len(sizes):
                n = -(-left[s] // (most // s))
                free(most, bins, n)
                bins += n
                i = len(sizes) - 1
            gap = sizes[i]
            base, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[i]
            copies = gap // s
            full = min(n, left[s] // copies)
            if full:
                put(s, full, copies, base, most - gap)
                free(gap - copies * s, base, full)
            if full < n:
                rest = left[s]
                if rest:
                    put(s, 1, rest, base + full, most - gap)
                    free(gap - rest * s, base + full, 1)
                    full += 1
                free(gap, base + full, n - full)
    return out


def pack_large_items(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence_tokens: int = SEQUENCE_TOKENS, end: int = 0) -> DataFrame:
    """Each piece with its place: ``id, piece`` (from 0), ``start`` (its document's ids before it), ``length, ids``
    (little-endian, 2 bytes an id, or 4 if the vocabulary needs them), ``ids_crc32`` (of 4-byte ids), ``sequence, offset``.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library; the driver reads it and sends it along.
    Of a document longer than ``sequence_tokens`` every piece is full but the first. ``end`` closes each document.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    own = spark.sparkContext.broadcast((text, byte_ranks(text)))  # of the tokenizer's size
    width = 2 if max(Tokenizer.from_str(text).get_vocab_size(), end) < 1 << 16 else 4
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {two.schema['id'].dataType.simpleString()}, piece int, start long, length int, task int, number long, ids_crc32 long, ids binary"
    pieces = materialize(two.mapInArrow(lambda it: _pieces(it, *own.value, sequence_tokens, end, width), schema), "pieces")
    by_task = materialize(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece_counts")
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(plan(counts, sequence_tokens), "length int, first long, bins long, copies long, base long, at long")
    runs = runs.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "copies", "base", "at"))).alias("runs"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = bounded_broadcast(by_task.select("length", "task", before.alias("before")), by_task.count(), 40)
    p = F.col("number") + F.col("before")
    run = F.element_at(F.filter("runs", lambda r: r["first"] <= p), -1)
    nth = p - F.col("run.first")
    placed = pieces.join(before, ["length", "task"]).join(F.broadcast(runs), "length").withColumn("run", run)
    return placed.select("id", "piece", "start", "length", "ids", "ids_crc32", (F.col("run.base") + F.expr("(number + before - run.first) div run.copies")).alias("sequence"),
                         (F.col("run.at") + nth % F.col("run.copies") * F.col("length")).alias("offset"))


def sequences(placed: DataFrame) -> DataFrame:
    """One row a sequence: ``sequence, n_tokens, input_ids, ids, pieces, cu_seqlens`` in the order of places."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "id", "piece", F.hex("ids").alias("ids"))))
    s = placed.groupBy("sequence").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    return s.select("sequence", "n_tokens", F.unhex(F.array_join("parts.ids", "")).alias("input_ids"), F.col("parts.id").alias("ids"), F.col("parts.piece").alias("pieces"),
                    F.concat("parts.offset", F.array("n_tokens")).alias("cu_seqlens"))
