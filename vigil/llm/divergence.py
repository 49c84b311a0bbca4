"""How far the sources of a language differ in their words, counted without moving words about.

1. A task counts the terms of each chunk of whole texts by (language, source). What it hands on has the term's digest, a
   fixed-width number, and the term itself only beside the digest's first row of the chunk. All counting, document
   frequencies, totals and joins shuffle digests.
2. The kept digests' smallest and greatest strings tell whether a digest stands for one term. Where they differ it is split:
   a second pass counts the terms of those digests by their text, and each gets a number within its digest.
3. Divergences are computed from (digest, number) keys. The term part keeps, by digest, the rows whose value ranks to
   ``TOP`` with ties, and only these are joined with their texts, which settle the ties. For the pair part, blocks of terms of
   one language become a matrix (terms by sources), whose column pairs are summed inside the task; a block holds at most
   ``BLOCK_CELLS`` cells or one term, and wide languages take ``TILE`` sources a task.

Definitions. A term is a match of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Each language keeps the V terms
in at least ``LEAST_DOCS`` of its documents (rows). A group (language, source), and each language, gives a kept term with c
occurrences p = 1 + floor(10^9 (c + 2) / (N + 2 V)), N the sum of c. Two shares differ by floor((p - q)^2 / (p + q)).

Defined results: null text, language or source is ''; a group without terms has N = 0; repeated rows count each; ties rank
by UTF-8 order of the item; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, bounded_broadcast, inverse_powers, materialize, mix, prefix_hash

LEAST_DOCS, TOP = 10, 10
#: Bytes of text that a task looks at together (one document at least).
CHUNK_BYTES = 4 << 20
BLOCK_CELLS, TILE = 1 << 16, 256

TERM_BYTE = np.zeros(256, dtype=bool)
TERM_BYTE[0x41:0x5B] = TERM_BYTE[0x61:0x7B] = TERM_BYTE[0x80:] = True


def _digest(terms: pa.LargeBinaryArray, bits: int) -> np.ndarray:
    _, at, data = terms.buffers()
    edge = np.frombuffer(at, dtype=np.int64)[terms.offset: terms.offset + len(terms) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[: edge[-1]]
    prefix = prefix_hash(raw)
    h = mix((prefix[edge[1:]] - prefix[edge[:-1]]) * inverse_powers(len(raw) + 1)[edge[:-1]])
    return (h >> np.uint64(64 - bits)).view(np.int64)


def _terms(texts: pa.Array) -> tuple[np.ndarray, pa.LargeBinaryArray, np.ndarray]:
    """For each term occurrence its number and its document; and the different terms by number."""
    texts = texts.cast(pa.large_binary())
    _, at, data = texts.buffers()
    edge = np.frombuffer(at, dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[edge[0]: edge[-1]] if data else np.zeros(0, np.uint8)
    edge = edge - edge[0]
    inside = TERM_BYTE[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    first = edge[:-1][edge[:-1] < len(raw)]
    begin[first] = inside[first]
    start = np.flatnonzero(begin)
    letters = LOWER[raw[inside]]
    offsets = np.concatenate((np.cumsum(inside)[start] - 1, [len(letters)])).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary, np.searchsorted(edge, start, "right") - 1


def _count(batches: Iterator[pa.RecordBatch], bits: int, all_terms: bool) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, source, digest, n, docs, term`` of each chunk: occurrences and documents; the term stands on each row if
    ``all_terms``, else on one row of the digest's term in the chunk."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK_BYTES, "right")))
            part = batch.slice(at, to - at)
            at = to
            code, terms, doc = _terms(part.column(2))
            if not len(code):
                continue
            groups = pa.StructArray.from_arrays([part.column(0), part.column(1)], ["lang", "source"]).to_pylist()
            number: dict[tuple, int] = {}
            group = np.array([number.setdefault((g["lang"], g["source"]), len(number)) for g in groups])
            by_group = np.argsort(group, kind="stable")  # documents by group: a term's rows of one group then lie together
            place = np.empty(len(group), np.int64)
            place[by_group] = np.arange(len(group))
            pair, n = np.unique(code.astype(np.int64) * len(group) + place[doc], return_counts=True)
            code, g = pair // len(group), group[by_group][pair % len(group)]
            new = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (g[1:] != g[:-1]))))
            docs = np.diff(np.concatenate((new, [len(pair)])))
            n, code, g = np.add.reduceat(n, new), code[new], g[new]
            keys = list(number)
            lang, source = (pa.DictionaryArray.from_arrays(pa.array(g, pa.int32()), pa.array([k[i] for k in keys], pa.string())).dictionary_decode() for i in (0, 1))
            show = np.ones(len(code), bool) if all_terms else np.concatenate(([True], code[1:] != code[:-1]))
            term = terms.take(pa.array(code, mask=~show)).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang, source, pa.array(_digest(terms, bits)[code]), pa.array(n), pa.array(docs), term], ["lang", "source", "digest", "n", "docs", "term"])


COUNTS = "lang string, source string, digest long, n long, docs long, term string"


def _blocks(t: pa.Table) -> pa.Table:
    """The partial sums of a block: each source of the tile against each source of the language. Rows without a digest give
    each source's share of terms that it lacks."""
    is_term = t["digest"].is_valid()
    base, rows = t.filter(pc.invert(is_term)), t.filter(is_term)
    lacking = np.zeros(base.num_rows, np.int64)
    lacking[base["at"].to_numpy()] = base["p"].to_numpy()
    digest, number = rows["digest"].to_numpy(), rows["part"].to_numpy()
    order = np.lexsort((number, digest))
    digest, number = digest[order], number[order]
    row = np.cumsum(np.concatenate(([False], (digest[1:] != digest[:-1]) | (number[1:] != number[:-1]))))
    shares = np.tile(lacking, (int(row[-1]) + 1, 1))
    shares[row, rows["at"].to_numpy()[order]] = rows["p"].to_numpy()[order]
    first = t["tile"][0].as_py() * TILE
    mine = np.arange(first, min(first + TILE, len(lacking)))
    sums = [((shares[:, i: i + 1] - shares) ** 2 // (shares[:, i: i + 1] + shares)).sum(axis=0) for i in mine]
    n = len(lacking)
    return pa.Table.from_arrays([pa.array([t["lang"][0].as_py()] * (len(mine) * n), pa.string()), pa.array(np.repeat(mine, n)), pa.array(np.tile(np.arange(n), len(mine))), pa.array(np.concatenate(sums))],
                                ["lang", "at", "other", "value"])


def _share(n: str, total: str) -> str:
    """SQL for 1 + floor(10^9 (n + 2) / (total + 2 kept)), exact."""
    return f"1 + (cast({n} + 2 as decimal(20, 0)) * 1000000000) div nullif(cast({total} + 2 * kept as decimal(20, 0)), cast(0 as decimal(20, 0)))"


def _split(three: DataFrame, counts: DataFrame, terms: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """``counts`` and ``terms`` keyed by (digest, part): part 0 for a digest of one term, 1, 2 ... for the terms of others."""
    clash = materialize(terms.where("low <> high").select("digest"), "clashes")
    n = clash.count()
    terms = terms.select("digest", F.lit(0).alias("part"), F.col("low").alias("term"))
    counts = counts.select("lang", "source", "digest", F.lit(0).alias("part"), "n", "docs")
    if not n:
        return counts, terms
    clash = bounded_broadcast(clash, n, 16)
    again = three.mapInArrow(lambda it: _count(it, bits, True), COUNTS).join(clash, "digest", "left_semi")
    again = materialize(again.groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "split_counts")
    numbered = again.select("digest", "term").distinct().withColumn("part", F.row_number().over(Window.partitionBy("digest").orderBy("term")))
    apart = again.join(numbered, ["digest", "term"]).select(*counts.columns)
    return counts.join(clash, "digest", "left_anti").unionByName(apart), terms.join(clash, "digest", "left_anti").unionByName(numbered.select(*terms.columns))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", digest_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """``pairs``: ``lang, source, other, value`` for all ordered pairs of sources of a language; ``terms``: ``lang, source,
    term, value, rank`` with the ``TOP`` terms in which a source's share most exceeds its language's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    three = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counted = materialize(three.mapInArrow(lambda it: _count(it, digest_bits, False), COUNTS), "chunk_counts")
    counts = materialize(counted.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")
    often = counts.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCS).select("digest").distinct()
    shown = counted.where("term IS NOT NULL").join(often, "digest", "left_semi")
    terms = materialize(shown.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "terms")
    counts, terms = _split(three, counts, terms, digest_bits)
    key = ["lang", "digest", "part"]
    kept = counts.groupBy(*key).agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCS).drop("docs")
    used = materialize(counts.drop("docs").join(kept, key), "kept_counts")

    of_source = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = used.groupBy(*key).agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    own = Window.partitionBy("lang")
    groups = three.select("lang", "source").distinct().join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    groups = groups.withColumn("at", (F.row_number().over(own.orderBy("source")) - 1).cast("long")).withColumn("sources", F.count("*").over(own))
    groups = materialize(groups.withColumn("lacking", F.expr(_share("0", "total"))), "groups")
    n_groups = groups.count()
    rows = used.join(bounded_broadcast(groups, n_groups, 128), ["lang", "source"]).withColumn("p", F.expr(_share("n", "total"))).withColumn("q", F.expr(_share("lang_n", "lang_total")))

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    top = rows.where("p > q").select("lang", "source", "digest", "part", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    top = top.withColumn("r", F.rank().over(ranked)).where(F.col("r") <= TOP).join(terms, ["digest", "part"])
    top = top.withColumn("rank", F.row_number().over(ranked.orderBy(F.desc("value"), "term"))).where(F.col("rank") <= TOP).select("lang", "source", "term", "value", "rank")

    blocks, tiles = F.ceil(F.col("kept") * F.col("sources") / BLOCK_CELLS), F.ceil(F.col("sources") / TILE)
    cells = rows.withColumn("block", F.pmod(F.xxhash64("digest", "part"), blocks)).withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
    base = groups.where("kept > 0").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
    base = base.select("lang", "block", "tile", F.lit(None).cast("long").alias("digest"), F.lit(0).alias("part"), "at", F.col("lacking").alias("p"))
    # A block without terms has nothing to add.
    filled = cells.select("lang", "block", "tile").distinct()
    both = cells.select(*base.columns).union(base.join(filled, ["lang", "block", "tile"], "left_semi"))
    sums = both.groupBy("lang", "block", "tile").applyInArrow(_blocks, "lang string, at long, other long, value long").groupBy("lang", "at", "other").agg(F.sum("value").alias("value"))
    left, right = groups.select("lang", "source", "at"), groups.select("lang", F.col("source").alias("other_source"), F.col("at").alias("other"))
    pairs = left.join(right, "lang").where("at <> other").join(sums, ["lang", "at", "other"], "left")
    return pairs.select("lang", "source", F.col("other_source").alias("other"), F.coalesce("value", F.lit(0)).alias("value")), top
