"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Words are runs of letters and digits or runs of signs, case kept, hashed to ``BUCKETS`` rows. Each row has a fixed sparse
random index vector; the word vector of a row is the sum of the index vectors of its neighbours (``REACH`` words to either
side) over the whole corpus, so it grows from all documents while its size stays ``BUCKETS x DIM`` at any scale. Sums
are whole numbers, hence the same in any order. A document is the weighted mean (frequent words count less) and the
spread of its word vectors. The network (tanh layer, then a logistic unit) learns on at most ``SAMPLE`` labelled rows,
the first in order of a hash of their id, and a fifth of these sets the temperature of its probabilities.

Only the text is an input of a score. Defined results: null or empty texts have all-zero features and a score like
any other; repeated rows score alike, and an id teaches once; with no labelled rows, or one class only, all scores are the (smoothed) share of
label 1; labels without a document, and null labels, teach nothing. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, prefix_hash, span_hash, text_bytes

BUCKETS, DIM, REACH, SAMPLE, HIDDEN = 1 << 14, 32, 2, 20_000, 32
FOLDS, SEED = 5, 17
_KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 letters and digits, 2 signs
_KIND[SPACE] = 0
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KIND[_a:_b] = 1


def word_rows(b: np.ndarray) -> np.ndarray:
    """The bucket of each word of a text's bytes, in order."""
    kind = _KIND[b]
    new = np.flatnonzero(np.diff(kind, prepend=0) != 0)
    if not len(new):
        return np.zeros(0, np.int64)
    ends = np.append(new[1:], len(b))
    word = kind[new] > 0
    return (span_hash(prefix_hash(b), new[word], ends[word]) % np.uint64(BUCKETS)).astype(np.int64)


def index_vectors() -> np.ndarray:
    """Sparse ternary index vectors; the last row, all zero, stands between documents."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS + 1, DIM), np.int16)
    for sign in (1, -1):
        out[np.arange(BUCKETS)[:, None], rng.integers(0, DIM, (BUCKETS, 3))] = sign
    return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's share of the word vectors: a row for each bucket that it met."""
    index, total, count = index_vectors(), np.zeros((BUCKETS, DIM), np.int64), np.zeros(BUCKETS, np.int64)
    gap = np.full(REACH, BUCKETS)
    waiting, n = [gap], 0

    def add() -> None:
        rows = np.concatenate(waiting)
        own = rows[REACH:-REACH]
        at = [index[rows[REACH + d: len(rows) - REACH + d]] for d in range(-REACH, REACH + 1) if d]
        around = sum(at[1:], at[0])
        order = np.argsort(own, kind="stable")
        words, first = np.unique(own[order], return_index=True)
        sums, sizes = np.add.reduceat(around[order].astype(np.int32), first, axis=0), np.diff(np.append(first, len(own)))
        real = words < BUCKETS
        total[words[real]] += sums[real]
        count[words[real]] += sizes[real]

    for batch in batches:
        for b in text_bytes(batch.column(0)):
            waiting += [word_rows(b), gap]
            n += len(waiting[-2])
            if n >= 100_000:
                add()
                waiting, n = [gap], 0
    if n:
        add()
    met = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(count[met]), *(pa.array(np.ascontiguousarray(total[met, i])) for i in range(DIM))], ["word", "n", *(f"v{i}" for i in range(DIM))])


def word_vectors(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Unit word vectors and word weights, from every document. Of fixed size, whatever the corpus."""
    schema = "word long, n long, " + ", ".join(f"v{i} long" for i in range(DIM))
    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_contexts, schema)
    sums = parts.groupBy("word").agg(F.sum("n").alias("n"), *(F.sum(f"v{i}").alias(f"v{i}") for i in range(DIM))).toPandas()
    vectors, n = np.zeros((BUCKETS, DIM)), np.zeros(BUCKETS)
    word = sums["word"].to_numpy(np.int64)
    n[word] = sums["n"].to_numpy(float)
    vectors[word] = sums[[f"v{i}" for i in range(DIM)]].to_numpy(float)
    vectors[n > 0] /= n[n > 0, None]
    share = n / max(n.sum(), 1.0)
    vectors -= share @ vectors
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return vectors.astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32)


def pool(b: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted mean and spread of a document's word vectors."""
    rows = word_rows(b)
    if not len(rows):
        return np.zeros(2 * DIM, np.float32)
    n = np.bincount(rows, minlength=0).astype(np.float32)
    met = np.flatnonzero(n)
    w = n[met] * weights[met]
    w /= w.sum()
    v = vectors[met]
    mean = w @ v
    return np.concatenate((mean, np.sqrt(np.maximum(w @ (v * v) - mean * mean, 0))))


class Network:
    """Two layers, fitted by full-batch Adam; probabilities are calibrated by one temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, rounds: int = 400, decay: float = 1e-4):
        rng = np.random.default_rng(SEED)
        self.rate = (y.sum() + 1.0) / (len(y) + 2.0)
        self.center, self.scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (0.0, 1.0)
        self.p, self.temperature = None, 1.0
        if len(np.unique(y)) < 2:
            return
        held = rng.permutation(len(y)) % 5 == 0
        if len(np.unique(y[held])) < 2 or len(np.unique(y[~held])) < 2:
            held[:] = False
        z, t = ((x - self.center) / self.scale).astype(np.float32), y.astype(np.float32)
        a, b = z[~held], t[~held]
        p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.array([np.log(self.rate / (1 - self.rate))])]
        p = [v.astype(np.float32) for v in p]
        m, s = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
        for k in range(1, rounds + 1):
            h = np.tanh(a @ p[0] + p[1])
            d = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - b) / len(b)
            back = np.outer(d, p[2]) * (1 - h * h)
            for i, g in enumerate((a.T @ back + decay * p[0], back.sum(0), h.T @ d + decay * p[2], np.array([d.sum()], np.float32))):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                p[i] = p[i] - 0.02 * (m[i] / (1 - 0.9**k)) / (np.sqrt(s[i] / (1 - 0.999**k)) + 1e-8)
        self.p = p
        if held.any():
            logit, u = self.logits(x[held]), t[held]
            loss = lambda c: np.mean(np.logaddexp(0, logit / c) - u * logit / c)
            self.temperature = float(min(np.geomspace(0.25, 8, 141), key=loss))

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.center) / self.scale).astype(np.float32)
        return np.tanh(z @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.p is None:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-self.logits(x).astype(float) / self.temperature))


def fold(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _features(batches: Iterator[pa.RecordBatch], vectors, weights) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [pool(b, vectors, weights) for b in text_bytes(batch.column(batch.num_columns - 1))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(x, pa.list_(pa.float32()))], ["id", "y", "x"])


def _scores(batches: Iterator[pa.RecordBatch], at: int, keep: int, vectors, weights, net: Network) -> Iterator[pa.RecordBatch]:
    """The first ``keep`` columns and the score of the text in column ``at``."""
    for batch in batches:
        x = np.array([pool(b, vectors, weights) for b in text_bytes(batch.column(at))], np.float32).reshape(-1, 2 * DIM)
        yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(net.scores(x))], [f"c{i}" for i in range(keep)] + ["score"])


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, sample: int) -> DataFrame:
    """``id, y, text``: at most ``sample`` labelled ids outside the held-out fold, first by a hash of the id. Of several labels
    of an id the greatest counts, of several texts the least in order of characters, so reruns learn from the same rows."""
    rows = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != 0)).groupBy(F.col(id_col).alias("of")).agg(F.max(label).cast("double").alias("y"))
    rows = F.broadcast(rows.orderBy(F.xxhash64(F.lit(SEED), "of"), "of").limit(sample))  # at most ``sample`` rows of two numbers
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).join(rows, F.col("id") == F.col("of")).groupBy("id").agg(F.first("y").alias("y"), F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE):
    vectors, weights = word_vectors(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, weights))
    chosen = labelled(docs, labels, label, id_col, text_col, sample)
    kind = chosen.schema["id"].dataType.simpleString()
    rows = chosen.mapInArrow(lambda it: _features(it, *shared.value), f"id {kind}, y double, x array<float>").toPandas()
    x = np.array(rows["x"].tolist(), np.float32).reshape(-1, 2 * DIM)
    y = rows["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # in a fixed order, however the rows came
    return shared, Network(x[order], y[order])


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, keep: bool = False) -> DataFrame:
    """``id, score`` for every row; with ``keep``, the whole input row as a struct ``row`` in place of ``id``."""
    shared, net = train(docs, labels, label, id_col, text_col, sample)
    names = docs.columns if keep else [id_col]
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    at = names.index(text_col) if keep else 1
    two = docs.select(*cols) if keep else docs.select(*cols, F.col(text_col).cast("string").alias("c1"))
    schema = T.StructType([*list(two.schema)[: len(names)], T.StructField("score", T.DoubleType())])
    out = two.mapInArrow(lambda it: _scores(it, at, len(names), *shared.value, net), schema)
    if not keep:
        return out.withColumnRenamed("c0", "id")
    return out.select(F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]).alias("row"), "score")
