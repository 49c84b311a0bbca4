"""Toxicity by a classifier chain over linear models.

Features are words and word beginnings (3 to 6 bytes), lower-cased, hashed, and counted. From the labelled rows Spark
counts in how many toxic and clean documents each occurs; the ``FEATURES`` with the strongest evidence are kept.

The chain predicts its categories one after the other: ``explicit`` (toxic by terms that the labels show to be toxic by
themselves), ``implicit`` (toxic without such terms), and ``toxic`` itself. Each model is a logistic regression over the
features and the probabilities of all categories before it; for training these come from models that did not see the
row (out of fold), as on new documents. Further label columns can be put into the chain.

Models learn on at most ``SAMPLE`` labelled rows, the first by a hash of their id, outside the held-out fold. All
documents are scored whole. Defined results: null or empty texts score by the intercepts; without labels, or with one
class only, scores are the smoothed share of toxic rows; repeated rows score alike, and an id teaches once; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, mix, prefix_hash, runs, span_hash, text_bytes
from .quality import labelled

SAMPLE, FEATURES, FOLDS, BEGINNINGS = 20_000, 1024, 5, (3, 4, 5, 6)
CHAIN = ("explicit", "implicit", "toxic")
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def feature_hashes(b: np.ndarray) -> np.ndarray:
    """Every word and word beginning of a text's bytes, with repeats."""
    starts, ends = runs(_LETTER[b])
    p = prefix_hash(LOWER[b])
    out = [span_hash(p, starts, ends)]
    for k in BEGINNINGS:
        at = starts[ends - starts > k]
        out.append(mix(span_hash(p, at, at + k) + np.uint64(k)))
    return np.concatenate(out)


class Lookup:
    """Counts of known features in a text: a small table by the low bits first, then the whole hash."""

    def __init__(self, hashes: np.ndarray, bits: int = 18):
        self.sorted, self.mask = np.sort(hashes.astype(np.uint64)), np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, dtype=bool)
        self.maybe[(self.sorted & self.mask).astype(np.int64)] = True

    def __call__(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = feature_hashes(b)
        h = h[self.maybe[(h & self.mask).astype(np.int64)]]
        if not len(self.sorted):
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        ids, n = np.unique(at[self.sorted[at] == h], return_counts=True)
        return ids, np.log1p(n)


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, rounds: int = 300) -> np.ndarray:
    """Weights and intercept (last) by Adam on the mean logistic loss."""
    x1 = np.concatenate((x, np.ones((len(x), 1), np.float32)), 1)
    rate = (y.sum() + 1.0) / (len(y) + 2.0)
    w = np.zeros(x1.shape[1], np.float32)
    w[-1] = np.log(rate / (1 - rate))
    if len(np.unique(y)) < 2:
        return w
    m, s = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        g = x1.T @ ((1 / (1 + np.exp(-(x1 @ w))) - y) / len(y)).astype(np.float32)
        g[:-1] += decay * w[:-1]
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w = w - np.float32(0.1) * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
    return w


class Chain:
    """Linear models, each given the probabilities of those before it."""

    def __init__(self, x: np.ndarray, labels: list[np.ndarray], folds: int = FOLDS):
        of = np.random.default_rng(5).permutation(len(x)) % folds
        self.models = []
        for y in labels:
            y = y.astype(np.float32)
            self.models.append(logistic(x, y))
            unseen = np.zeros((len(x), 1), np.float32)
            for k in range(folds):
                if (of == k).any():
                    unseen[of == k, 0] = self.probability(logistic(x[of != k], y[of != k]), x[of == k])
            x = np.concatenate((x, unseen), 1)

    @staticmethod
    def probability(w: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30).astype(float)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = []
        for w in self.models:
            out.append(self.probability(w, x))
            x = np.concatenate((x, out[-1][:, None].astype(np.float32)), 1)
        return np.array(out).T


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = [np.unique(feature_hashes(b)).view(np.int64) for b in text_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h, pa.list_(pa.int64()))], ["y", "h"])


def _counts(batches: Iterator[pa.RecordBatch], find: Lookup) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [find(b) for b in text_bytes(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.list_(pa.float64()))], ["id", "y", "f", "v"])


def _dense(found: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    x = np.zeros((len(found), n), np.float32)
    for i, (f, v) in enumerate(found):
        x[i, np.asarray(f, np.int64)] = v
    return x


def _scores(batches: Iterator[pa.RecordBatch], find: Lookup, chain: Chain) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            p = chain(_dense([find(b) for b in text_bytes(part.column(1))], len(find.sorted)))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(p[:, i]) for i in range(p.shape[1]))], ["id", *CHAIN])


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, features: int = FEATURES) -> DataFrame:
    """``id`` and a probability for each category of the chain, for every input row."""
    chosen = labelled(docs, labels, label, id_col, text_col, sample)
    total = chosen.groupBy("y").count().collect()  # two rows
    n = {r["y"]: r["count"] for r in total}
    pos, neg = n.get(1.0, 0), n.get(0.0, 0)
    found = chosen.select("y", "text").mapInArrow(_hashes, "y double, h array<long>").select("y", F.explode("h").alias("h"))
    found = found.groupBy("h").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).where("t + c >= 5")
    # Signed chi-square evidence; equal strength by hash. The result has ``features`` rows.
    rate_t, rate_c = F.col("t") / max(pos, 1), F.col("c") / max(neg, 1)
    both = (F.col("t") + F.col("c")) / max(pos + neg, 1)
    z = (rate_t - rate_c) / F.sqrt(both * (1 - both) * (1 / max(pos, 1) + 1 / max(neg, 1)) + 1e-12)
    best = found.select("h", "t", "c", z.alias("z")).orderBy(F.abs("z").desc(), "h").limit(features).collect()
    find = Lookup(np.array([r["h"] for r in best], dtype=np.int64).view(np.uint64))
    place = {int(h): i for i, h in enumerate(find.sorted.view(np.int64).tolist())}
    plain = np.array(sorted(place[r["h"]] for r in best if r["t"] > 9 * r["c"] and r["t"] >= 10), dtype=np.int64)
    kind = chosen.schema["id"].dataType
    rows = chosen.mapInArrow(lambda it: _counts(it, find), T.StructType([T.StructField("id", kind), T.StructField("y", T.DoubleType()), T.StructField("f", T.ArrayType(T.LongType())), T.StructField("v", T.ArrayType(T.DoubleType()))])).orderBy("id").toPandas()
    x, y = _dense(list(zip(rows["f"], rows["v"], strict=True)), len(find.sorted)), rows["y"].to_numpy(float)
    by_terms = (x[:, plain] > 0).any(1) if len(plain) else np.zeros(len(x), dtype=bool)
    chain = Chain(x, [y * by_terms, y * ~by_terms, y])
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", two.schema["id"].dataType), *(T.StructField(c, T.DoubleType()) for c in CHAIN)])
    return two.mapInArrow(lambda it: _scores(it, find, chain), schema)
