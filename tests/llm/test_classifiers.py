"""The classifiers against plain versions that go word by word, and held-out figures."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from vigil.llm import quality, toxicity
from vigil.llm.common import ship
from vigil.llm.queries import QUERIES

from .conftest import SF


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def _tables(spark, words, n=260):
    rng = random.Random(31)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = " ".join(rng.choices(words[:80] if bad else words[60:], k=rng.randint(0, 60))) + (" !!!??" if bad else ".") + (" vileword" if i % 6 == 0 else "")
        rows.append((i, text, "q"))
        labels.append((i, int(not bad) if i % 10 else None, int(i % 6 == 0 or i % 9 == 0)))
    rows += [(None, "no id at all", "q"), (7, "second text of seven", "q"), (8, None, "q"), (9, "", "q"), (10, rows[10][1], "q")]
    labels += [(11, 0, 1), (11, 1, 0), (None, 1, 1), (9999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, y string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def _training(docs, labels, label):
    """Ids outside the held-out fold, their greatest label and least text."""
    import zlib
    y = {}
    for r in labels.collect():
        if r.doc_id is not None and r[label] is not None and zlib.crc32(str(r.doc_id).encode()) % 5:
            y[r.doc_id] = max(y.get(r.doc_id, 0), r[label])
    texts = {}
    for r in docs.collect():
        if r.doc_id in y:
            texts[r.doc_id] = min(texts.get(r.doc_id, r.text or ""), r.text or "")
    return [(i, y[i], texts[i]) for i in sorted(texts)]


def test_quality_matches_a_plain_version(spark, words):
    docs, labels = _tables(spark, words)
    index = quality.index_vectors().astype(int)
    split = lambda t: [w.encode() for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\x20\x09-\x0D0-9A-Za-z\x80-\U0010ffff]+", t or "")]
    bucket = {w: int(quality.word_rows(np.frombuffer(w, np.uint8))[0]) for r in docs.collect() for w in split(r.text)}
    total, count = defaultdict(lambda: np.zeros(quality.DIM, int)), Counter()
    for r in docs.collect():
        ws = [bucket[w] for w in split(r.text)]
        for i, w in enumerate(ws):
            count[w] += 1
            for j in range(max(0, i - quality.REACH), min(len(ws), i + quality.REACH + 1)):
                if j != i:
                    total[w] = total[w] + index[ws[j]]
    every = sum(count.values())
    mean = sum(total[w] for w in count) / every
    vector = {w: total[w] / count[w] - mean for w in count}
    vector = {w: v / max(np.linalg.norm(v), 1e-9) for w, v in vector.items()}
    weight = {w: 1e-3 / (1e-3 + count[w] / every) for w in count}

    def pooled(text):
        ws = [bucket[w] for w in split(text)]
        if not ws:
            return np.zeros(2 * quality.DIM)
        share = sum(weight[w] for w in ws)
        m = sum(weight[w] * vector[w] for w in ws) / share
        sq = sum(weight[w] * vector[w] ** 2 for w in ws) / share
        return np.concatenate((m, np.sqrt(np.maximum(sq - m * m, 0))))

    rows = _training(docs, labels, "quality")
    x, y = np.array([pooled(t) for _, _, t in rows], np.float32), np.array([float(v) for _, v, _ in rows])
    got = {r.id: r.score for r in quality.score(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), labels).collect()}
    assert set(got) >= {8, 9}
    # The features agree; the network is fitted on them in the operator's order, so its scores may differ by rounding only.
    shared, net = quality.train(docs, labels)
    mine = np.array([quality.pool(np.frombuffer(t.encode(), np.uint8), *shared.value) for _, _, t in rows])
    assert np.abs(mine - x).max() < 1e-4
    order = np.lexsort((*mine.T, y))
    plain = quality.Network(x[order], y[order])
    a = plain.scores(x)
    b = {(r.id, r.score) for r in quality.score(docs, labels).collect()}
    first = {i: s for i, s in b if i is not None and i not in (7, 8, 9, 10)}  # ids with one text
    assert max(abs(first[i] - s) for (i, _, _), s in zip(rows, a) if i in first) < 0.02
    assert 0.25 <= net.temperature <= 8 and abs(net.temperature - plain.temperature) < 0.2


def test_calibration_lowers_the_loss():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 6)).astype(np.float32)
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(float)
    net = quality.Network(x, y)
    held = rng.normal(size=(4000, 6)).astype(np.float32)
    truth = held[:, 0] + rng.normal(size=4000) > 0
    loss = lambda t: np.mean(np.logaddexp(0, net.logits(held) / t) - truth * net.logits(held) / t)
    assert net.temperature > 1 and loss(net.temperature) < loss(1.0)


def _grams(text):
    """Words and word beginnings, lower-cased, by bytes."""
    out = []
    for w in re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode()):
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
        out += [("word", w)] + [("begins", w[:k]) for k in toxicity.BEGINNINGS if len(w) > k]
    return out


def test_toxicity_matches_a_plain_version(spark, words, monkeypatch):
    docs, labels = _tables(spark, words)
    rows = _training(docs, labels, "toxic")
    n = {v: sum(y == v for _, y, _ in rows) for v in (0, 1)}
    seen = defaultdict(lambda: [0, 0])
    for _, y, t in rows:
        for g in set(_grams(t)):
            seen[g][y] += 1
    evidence = {}
    for g, (c, t) in seen.items():
        if c + t >= 5:
            both = (c + t) / len(rows)
            evidence[g] = (t / n[1] - c / n[0]) / np.sqrt(both * (1 - both) * (1 / n[1] + 1 / n[0]) + 1e-12)
    # All features are kept here, so their order does not matter to the sums but for rounding.
    assert len(evidence) <= 4000
    kept = sorted(evidence)
    explicit = {g for g in kept if seen[g][1] > 9 * seen[g][0] and seen[g][1] >= 10}
    dense = lambda t: np.array([np.log1p(c[g]) for c in [Counter(_grams(t))] for g in kept], np.float32)
    x, y = np.array([dense(t) for _, _, t in rows]), np.array([float(v) for _, v, _ in rows])
    terms = np.array([bool(explicit & set(_grams(t))) for _, _, t in rows])
    of = np.random.default_rng(5).permutation(len(x)) % toxicity.FOLDS
    models, wide = [], x
    for target in (y * terms, y * ~terms, y):
        target = target.astype(np.float32)
        models.append(toxicity.logistic(wide, target))
        unseen = np.zeros(len(x), np.float32)
        for k in range(toxicity.FOLDS):
            w = toxicity.logistic(wide[of != k], target[of != k])
            unseen[of == k] = 1 / (1 + np.exp(-(wide[of == k] @ w[:-1] + w[-1])))
        wide = np.concatenate((wide, unseen[:, None]), 1)

    def chain(text):
        f, out = dense(text), []
        for w in models:
            out.append(1 / (1 + np.exp(-(f @ w[:-1] + w[-1]))))
            f = np.append(f, np.float32(out[-1]))
        return out

    got = toxicity.score(docs, labels, features=4000).collect()
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    assert len(got) == sum(texts.values())
    want = defaultdict(list)
    for (i, t), k in texts.items():
        want[i] += [chain(t)] * k
    for r in got:
        assert min(max(abs(a - b) for a, b in zip((r.explicit, r.implicit, r.toxic), p)) for p in want[r.id]) < 1e-2


def test_reruns_learn_the_same_from_an_id_with_two_texts(spark, words):
    docs, labels = _tables(spark, words)
    a, b = ({(r.id, round(r.toxic, 5)) for r in toxicity.score(d, labels).collect()} for d in (docs, docs.repartition(5, "text")))
    assert a == b


def _auc(scores, truth):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    return (order[truth].sum() - truth.sum() * (truth.sum() + 1) / 2) / (truth.sum() * (~truth).sum())


@pytest.mark.parametrize("key, label", [("op4_quality", "quality"), ("op7_toxicity", "toxic")])
def test_held_out(spark, key, label):
    sf = SF.replace("sf0.001", "sf0.01")
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r[label] is not None}
    rows = [r for r in QUERIES[key](spark, sf).collect() if r.held_out and r.doc_id in truth]
    y = np.array([truth[r.doc_id] == 1 for r in rows])
    assert len(rows) >= 60 and _auc(np.array([r.score for r in rows]), y) >= 0.9
