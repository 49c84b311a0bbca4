"""Benchmark decontamination by winnowing. DataFrame functions only.

Texts are sequences of words (lower-cased A-Z, digits, every code point from U+0080). Of every ``window`` (10)
consecutive words, the k-gram (``gram`` = 5 words) with the smallest hash is kept: two equal windows keep the same
gram, so a shared span of ``window`` words always shares a fingerprint. A document gives one row for each run of
windows that keep the same gram. Fingerprints of documents and benchmark windows are joined, and each hit is extended
by comparing the words of the whole window, so a hash collision finds nothing.

An item shorter than a window is one window of its own length, looked up by the hash of all its words.

The benchmark side is broadcast when its counted size is under the bound and shuffled otherwise; document rows
carry only the words around their fingerprint.

Defined results: null or wordless texts have no words and no hits; a row is known by its id and its text's digest, so
rows of one id or without an id that have other texts count alone, and repeated rows have the same hits; an empty
benchmark gives no hits. Own columns are prefixed, columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bounded_broadcast, materialize, text_key

#: What separates words, once A-Z are in lower case.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 5


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), SEPARATOR), ""), F.array().cast("array<string>"))


def _paired(df: DataFrame, out: str, left: str, right: str, by: int, length: Column, join) -> DataFrame:
    """Column ``out``: ``join`` of ``left`` at each place and ``right`` ``by`` places on."""
    return df.withColumn(out, F.zip_with(F.slice(left, 1, length), F.slice(right, by + 1, length), join))


def kept_grams(df: DataFrame) -> DataFrame:
    """Adds ``m``: for each window of WINDOW words in ``w`` (that many at least) the smallest of its GRAM-word hashes.
    Hashes of 2, 4 and 5 words, then minima over 2, 4 and 6 of them: a few array operations, whatever the width."""
    n, pair, low = F.size("w"), lambda a, b: F.xxhash64(a, b), lambda a, b: F.least(a, b)
    left = lambda k: F.greatest(n - k, F.lit(0))  # noqa: E731  a shorter text keeps nothing
    df = df.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    df = _paired(df, "g2", "wh", "wh", 1, left(1), pair)
    df = _paired(df, "g4", "g2", "g2", 2, left(3), pair)
    df = _paired(df, "g5", "g4", "wh", 4, left(4), pair)
    df = _paired(df, "m2", "g5", "g5", 1, left(5), low)
    df = _paired(df, "m4", "m2", "m2", 2, left(7), low)
    return _paired(df, "m", "m4", "m2", 4, left(9), low).drop("wh", "g2", "g4", "g5", "m2", "m4")


def benchmark_windows(bench: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(window_id, n, words, fp)`` and their items ``(window_id, item)``."""
    w = bench.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    n = F.least(F.size("w"), F.lit(WINDOW))
    w = w.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("words"))
    w = w.withColumn("window_id", F.sha2(F.concat_ws(" ", "words"), 256)).distinct()
    items = w.select("window_id", "item")
    kinds = w.select("window_id", F.col("words").alias("w"), F.size("words").alias("n")).distinct()
    full = kept_grams(kinds.where(F.col("n") == WINDOW)).select("window_id", "n", F.col("w").alias("words"), F.element_at("m", 1).alias("fp"))
    short = kinds.where(F.col("n") < WINDOW).select("window_id", "n", F.col("w").alias("words"), F.xxhash64("w").alias("fp"))
    return full.union(short), items


def hits(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(doc, sum, window_id, start, n)``: every occurrence of a benchmark window in a document; and the windows' items."""
    windows, items = benchmark_windows(bench, item_col, item_text_col)
    windows, items = materialize(windows, "bench_windows"), materialize(items, "bench_items")
    sizes = {r["n"]: (r["k"], r["b"]) for r in windows.groupBy("n").agg(F.count("*").alias("k"), F.sum(F.octet_length(F.concat_ws(" ", "words"))).alias("b")).collect()}  # at most WINDOW rows
    base = docs.select(F.col(id_col).alias("doc"), text_key(F.col(text_col)).alias("sum"), words(F.col(text_col)).alias("w"))
    found = []
    for n, (rows, octets) in sorted(sizes.items()):
        side = bounded_broadcast(windows.where(F.col("n") == n), rows, 200 + octets // max(rows, 1))
        if n == WINDOW:  # a row for each run of windows that keep the same gram
            at = kept_grams(base).withColumn("c", F.filter(F.sequence(F.lit(0), F.greatest(F.size("m") - 1, F.lit(0))), lambda i: (i == 0) | (F.get("m", i) != F.get("m", i - 1))))
            at = at.select("doc", "sum", "w", "m", "c", F.posexplode_outer("c").alias("k", "first"))
            at = at.select("doc", "sum", "w", "first", (F.coalesce(F.get("c", F.col("k") + 1), F.size("m")) - F.col("first")).alias("run"), F.get("m", F.col("first")).alias("h"))
        else:
            at = base.select("doc", "sum", "w", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))).alias("first"))
            at = at.select("doc", "sum", "w", "first", F.lit(1).alias("run"), F.xxhash64(F.slice("w", F.col("first") + 1, n)).alias("h"))
        at = at.select("doc", "sum", "first", "run", "h", F.slice("w", F.col("first") + 1, F.col("run") + n - 1).alias("near"))
        hit = at.join(side, F.col("h") == F.col("fp"))
        same = F.filter(F.sequence(F.lit(0), F.col("run") - 1), lambda i: F.slice("near", i + 1, n) == F.col("words"))
        found.append(hit.select("doc", "sum", "window_id", "first", F.explode(same).alias("i")).select("doc", "sum", "window_id", (F.col("first") + F.col("i")).alias("start"), F.lit(n).alias("n")))
    out = found[0] if found else base.select("doc", "sum", F.lit("").alias("window_id"), F.lit(0).alias("start"), F.lit(0).alias("n")).where("false")
    for x in found[1:]:
        out = out.union(x)
    return materialize(out.distinct(), "bench_hits"), items


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document that holds a benchmark window: ``doc, sum`` (``text_key`` of its text), ``spans`` (merged, of word places, end exclusive), ``n_hit``
    words, ``items``: the item ids found, as sorted strings."""
    found, items = hits(docs, bench, id_col, text_col, item_col, item_text_col)
    spans = found.groupBy("doc", "sum").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("stop")))).alias("s"))
    merged = F.aggregate("s", F.struct(F.array().cast("array<struct<start:int,stop:int>>").alias("done"), F.lit(0).alias("start"), F.lit(0).alias("stop")),
                         lambda a, x: F.when(x["start"] <= a["stop"], F.struct(a["done"].alias("done"), F.when(a["stop"] > 0, a["start"]).otherwise(x["start"]).alias("start"), F.greatest(a["stop"], x["stop"]).alias("stop")))
                         .otherwise(F.struct(F.when(a["stop"] > 0, F.array_append(a["done"], F.struct(a["start"].alias("start"), a["stop"].alias("stop")))).otherwise(a["done"]).alias("done"), x["start"].alias("start"), x["stop"].alias("stop"))),
                         lambda a: F.array_append(a["done"], F.struct(a["start"].alias("start"), a["stop"].alias("stop"))))
    spans = spans.select("doc", "sum", merged.alias("spans"))
    spans = spans.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"]))
    named = found.select("doc", "sum", "window_id").distinct().join(items, "window_id").groupBy("doc", "sum").agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = F.col("s.doc").eqNullSafe(F.col("n.doc")) & (F.col("s.sum") == F.col("n.sum"))
    return spans.alias("s").join(named.alias("n"), same).select("s.doc", "s.sum", "spans", "n_hit", "items")
