"""Source divergence, periodic runs and large-item packing against brute force, and on odd tables."""
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigil.llm import divergence, large_items, packing, periodic
from vigil.llm.common import ship
from vigil.llm.oracle import ORACLE
from vigil.llm.queries import QUERIES, with_period

from .conftest import SF

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


# --- divergence ---

def _terms(text):
    out, word = [], b""
    for b in (text or "").encode() + b" ":
        if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128:
            word += bytes([b + 32 if 65 <= b <= 90 else b])
        elif word:
            out.append(word.decode())
            word = b""
    return out


def _audit(rows):
    """Pairs and terms from (lang, source, text) rows, term by term."""
    rows = [(a or "", b or "", _terms(t)) for a, b, t in rows]
    pairs, top = {}, {}
    for lang in {r[0] for r in rows}:
        docs = Counter(w for a, _, t in rows if a == lang for w in set(t))
        kept = [w for w, n in docs.items() if n >= divergence.LEAST_DOCS]
        count = defaultdict(Counter)
        for a, b, t in rows:
            if a == lang:
                count[b].update(w for w in t if w in docs)
        share = lambda c: {w: 1 + 10**9 * (c[w] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for w in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(sum(count.values(), Counter()))
        p = {b: share(c) for b, c in count.items()}
        for b in p:
            for c in p:
                if b != c:
                    pairs[lang, b, c] = sum(f(p[b][w], p[c][w]) for w in kept)
            mine = sorted(((-f(p[b][w], q[w]), w.encode()) for w in kept if count[b][w] and p[b][w] > q[w]))[:divergence.TOP]
            top[lang, b] = [(w.decode(), -v) for v, w in mine]
    return pairs, top


def _compare(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, term int, p string")
    pairs, terms = divergence.audit(df, **more)
    want_pairs, want_top = _audit(rows)
    assert {(r.lang, r.source, r.other): r.value for r in pairs.collect()} == want_pairs
    got = defaultdict(list)
    for r in sorted(terms.collect(), key=lambda r: r["rank"]):
        got[r.lang, r.source].append((r.term, r.value))
    assert got == {k: v for k, v in want_top.items() if v}


def _rows(words, n=300):
    rng = random.Random(8)
    langs, sources = ["en", "de", None], ["a", "b", None, "Ü", "e"]
    rows = [(rng.choice(langs), rng.choice(sources), " ".join(rng.choice(words[:60]) for _ in range(rng.randint(0, 40)))) for _ in range(n)]
    return rows + [("en", "a", "Éa É_éa 9x9X"), ("fr", "only", "some words"), ("fr", "none", ""), ("en", "quiet", None), ("de", "a", "w" * 40_000 + " " + "tail " * 40_000)] + rows[:5] * 3


@pytest.mark.parametrize("bits", [64, 5])
def test_divergence(spark, words, bits, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 2000)
    _compare(spark, _rows(words), digest_bits=bits)


def test_divergence_without_broadcast_in_blocks_and_tiles(spark, words, monkeypatch):
    monkeypatch.setattr("vigil.llm.common.BROADCAST_BYTES", 0)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 7)
    _compare(spark, _rows(words, 150), digest_bits=5)


def test_divergence_tiles(words):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    n, t = 600, 5
    base = [("en", 0, k, None, 0, i, 100 + i) for k in range(3) for i in range(n)]
    shares = {(d, i): int(rng.integers(1, 10**9)) for d in range(t) for i in rng.choice(n, 40, replace=False).tolist()}
    dense = np.array([[shares.get((d, i), 100 + i) for i in range(n)] for d in range(t)])
    seen = 0
    for tile in range(3):
        rows = [r for r in base if r[2] == tile] + [("en", 0, tile, d // 2, d % 2, i, p) for (d, i), p in shares.items()]
        got = divergence._blocks(pa.Table.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "block", "tile", "digest", "part", "at", "p"])).to_pydict()
        for i, j, v in list(zip(got["at"], got["other"], got["value"]))[::97]:
            assert v == sum(int(p - q) ** 2 // int(p + q) for p, q in zip(dense[:, i], dense[:, j]))
        seen += len(got["at"])
    assert seen == n * n


def test_divergence_empty_tables(spark, odd_docs, no_docs):
    odd = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    pairs, terms = divergence.audit(odd)
    want, _ = _audit([(None, r.source, r.text) for r in odd.collect()])
    assert {(r.lang, r.source, r.other): r.value for r in pairs.collect()} == want and set(want.values()) == {0}
    assert terms.count() == 0
    pairs, terms = divergence.audit(no_docs.withColumn("lang", F.lit("x")))
    assert pairs.count() == terms.count() == 0


def test_divergence_shuffles_no_words(spark, words):
    """Only the smallest and greatest strings of a digest and the kept rows' texts are text."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(["a", "b", "a", "b"]), pa.array(["x y", "x z", "y", "x"])], ["lang", "source", "text"])
    rows = [r for b in divergence._count(iter([batch]), 64, False) for r in b.to_pylist()]
    assert sum(r["term"] is not None for r in rows) == 3 and len(rows) == 4 and len({r["digest"] for r in rows}) == 3


# --- periodic runs ---

def _runs(w):
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def _strange(rng):
    k, n, mode = rng.choice([1, 2, 3, 50]), rng.randint(0, 200), rng.randint(0, 4)
    some = lambda m, k=k: [rng.randrange(k) for _ in range(m)]
    if mode == 0:
        return some(n)
    if mode == 1:
        p = rng.randint(1, 40)
        return some(rng.randint(0, 20), 9) + (some(p) * (n // p + 1))[:n] + some(rng.randint(0, 20))
    if mode == 2:  # periods within periods
        return ((some(rng.randint(1, 6)) * rng.randint(1, 12) + some(rng.randint(0, 5), 3)) * rng.randint(1, 6))[:600]
    if mode == 3:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b
    w = _strange(rng)
    for _ in range(rng.randint(0, 3)):
        if w:
            w[rng.randrange(len(w))] = rng.randrange(3)
    return w


@pytest.mark.parametrize("seed", range(3))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    found = 0
    for _ in range(120):
        docs = [_strange(rng) for _ in range(rng.randint(1, 6))]
        want, off = [], 0
        for d in docs:
            want += [(s + off, n, q) for s, n, q in _runs(d)]
            off += len(d)
        got = periodic.find_runs(np.array([x for d in docs for x in d], np.int64), np.repeat(np.arange(len(docs)), [len(d) for d in docs]))
        assert list(zip(*(a.tolist() for a in got))) == want
        found += len(want)
    assert found > 100


def test_wavelet():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        v = rng.permutation(n)
        tree = periodic.Wavelet(v)
        lo = rng.integers(0, n, 50)
        hi = np.minimum(n, lo + rng.integers(1, n + 1, 50))
        bound = rng.integers(0, n + 1, 50)
        assert tree.below(lo, hi, bound).tolist() == [int((v[a:b] < x).sum()) for a, b, x in zip(lo, hi, bound)]
        k = (hi - lo) // 2
        assert tree.smallest(lo, hi, k).tolist() == [int(np.sort(v[a:b])[i]) for a, b, i in zip(lo, hi, k)]


def test_runs_on_odd_tables(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 100)
    got = periodic.periodic_runs(odd_docs).collect()
    assert len(got) == odd_docs.count() and periodic.periodic_runs(no_docs).count() == 0
    texts = Counter((r.doc_id, r.text) for r in odd_docs.collect())
    want = Counter()
    for (i, text), n in texts.items():
        w = (text or "").split()
        runs = _runs(w) if len(w) < 5000 else []
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        want[i, len(w), tuple(runs), " ".join(x for k, x in enumerate(w) if k not in gone)] += n
    assert Counter((r.id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == want
    assert {r.id: r.collapsed for r in got}[12] == "ab"


def test_long_periodic_document():
    w = np.tile(np.arange(3_000), 5)
    assert [a.tolist() for a in periodic.find_runs(w, np.zeros(len(w), np.int64))] == [[0], [15_000], [3_000]]


def test_planted_period(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(40 + i)), "e") for i in range(60)] + [(None, "a b", "e"), (7, None, "e"), (8, " ", "e")], "doc_id long, text string, n string")
    for r in with_period(docs).collect():
        if r.doc_id is None or not (r.text or "").strip():
            continue
        h = zlib.crc32(str(r.doc_id).encode())
        w = [f"w{k}" for k in range(40 + r.doc_id)]
        if h % 10 == 0:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert r.text.split() == w


# --- large items ---

@pytest.mark.parametrize("seed", range(4))
def test_plan_fills_sequences(seed):
    rng = random.Random(seed)
    for _ in range(80):
        most = rng.choice([10, 50, 200])
        counts = {rng.randint(1, most): rng.randint(0, 30) for _ in range(rng.randint(0, 40))}
        bins = defaultdict(list)
        got = Counter()
        plan = large_items.plan(counts, most)
        for length, first, n, copies, base, at in plan:
            assert first == got[length]
            got[length] += n * copies
            for b in range(n):
                bins[base + b] += [(at + k * length, length) for k in range(copies)]
        assert got == Counter({k: v for k, v in counts.items() if v}) and sorted(bins) == list(range(len(bins)))
        for held in bins.values():
            held.sort()
            assert [a for a, _ in held] == np.cumsum([0] + [n for _, n in held])[:-1].tolist() and sum(n for _, n in held) <= most
            assert sum(3 * n > most for _, n in held) <= 2
        assert len(plan) < 55 * most
        plain = packing.best_fit_decreasing([k for k, v in counts.items() for _ in range(v)], most)
        assert len(bins) <= len(plain) + 1


def test_large_items_alone_are_matched_best():
    # Items above a third: no packing needs fewer sequences than a greatest matching of pairs that fit.
    rng = random.Random(5)
    for _ in range(60):
        items = [rng.randint(4, 10) for _ in range(rng.randint(1, 9))]
        n = max(b + c for _, _, b, _, c, _ in large_items.plan(Counter(items), 10))

        def least(left):
            if not left:
                return 0
            a, rest = left[0], left[1:]
            return 1 + min([least(rest)] + [least(rest[:k] + rest[k + 1:]) for k in range(len(rest)) if a + rest[k] <= 10])
        assert n == least(items)


@pytest.mark.parametrize("chars", [1, 7, 1000])
def test_units_are_the_tokenizer(spark, monkeypatch, chars):
    monkeypatch.setattr(large_items, "PART_CHARS", chars)
    monkeypatch.setattr(large_items, "CALL_UNITS", 3)
    text = open(BPE, encoding="utf-8").read()
    units = large_items.Units(text, large_items.byte_ranks(text))
    assert units.by_rank is not None
    rng = random.Random(6)
    texts = ["a b  c \n d\n\n e", " x", "x ", "", "  ", "it's a 'll  we'll  z <|endoftext|> q", "a\t b", "\x1f a \x1f b", "<|endoftext|>", "a <|endoftext|>b ", "\x00\x00apart\x00\x00 x", "日本 語 ab ñandú, añil.", "e\u0301 x\u0301"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["".join(rng.choice(" ab\n\t 　'l1.\x1c\x85é") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for s, ids in zip(texts, units.encode(texts), strict=True):
        assert ids.tolist() == units.own.encode(s, add_special_tokens=False).ids


def test_ranks_only_where_they_are_the_merges():
    import json
    t = json.loads(open(BPE, encoding="utf-8").read())
    assert len(large_items.byte_ranks(json.dumps(t))) == 50_256
    t["model"]["merges"][5], t["model"]["merges"][6] = t["model"]["merges"][6], t["model"]["merges"][5]
    assert large_items.byte_ranks(json.dumps(t)) is None
    assert large_items.byte_ranks(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()) is None


def _whole(spark, docs, most, **more):
    """Places checked against the tokenizer, and the rows."""
    own = Tokenizer.from_file(BPE)
    rows = large_items.pack_large_items(docs, BPE, sequence_tokens=most, **more).collect()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = [*own.encode(r.text or "", add_special_tokens=False).ids, 0]
        at = 0
        for k in range(-(-len(ids) // most)):
            n = (len(ids) % most or most) if k == 0 else most
            want[r.doc_id, k, at, n, zlib.crc32(np.array(ids[at: at + n], "<u4").tobytes())] += 1
            at += n
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence].append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist() and sum(n for _, n in parts) <= most
    return rows, held


def test_large_item_packing_odd(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(large_items, "UNITS_KEPT", 50)
    monkeypatch.setattr(large_items, "PART_CHARS", 1000)
    rows, held = _whole(spark, odd_docs, 64)
    assert large_items.pack_large_items(no_docs, BPE).count() == 0
    monkeypatch.setattr("vigil.llm.common.BROADCAST_BYTES", 0)
    again, _ = _whole(spark, odd_docs, 64)
    assert Counter(r.length for r in again) == Counter(r.length for r in rows)


def test_one_length_and_one_id_may_be_hot(spark):
    docs = spark.createDataFrame([(1, "same text of one length", "p")] * 3000 + [(None, "t " * (k % 90), "p") for k in range(1500)], "doc_id long, text string, piece string").repartition(7)
    rows, held = _whole(spark, docs, 128)
    assert len(held) <= -(-sum(r.length for r in rows) // 128) * 1.02


def test_sequences_and_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    placed = large_items.pack_large_items(docs, BPE)
    placed.write.parquet(str(tmp_path / "placed"))
    placed = spark.read.parquet(str(tmp_path / "placed"))
    s = large_items.sequences(placed).collect()
    total = placed.agg(F.sum("length")).first()[0]
    assert sum(r.n_tokens for r in s) == total and len(s) <= -(-total // 2048) * 1.05 + 1
    own = Tokenizer.from_file(BPE)
    back = defaultdict(dict)
    for r in s:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert r.cu_seqlens[-1] == len(ids) == r.n_tokens
        for i, k, a, b in zip(r.ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            back[i][k] = ids[a:b].tolist()
    for r in docs.collect():
        assert sum((back[r.doc_id][k] for k in sorted(back[r.doc_id])), []) == [*own.encode(r.text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("n", [11, 12, 13])
def test_one_query_each(n):
    assert sum(k.startswith(f"op{n}_") for k in QUERIES) == 1


def test_oracle_finds_runs():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = con.execute(ORACLE["op12_periodic_runs"]).fetchall()
    assert sum(r[1] > 0 for r in rows) >= 5
