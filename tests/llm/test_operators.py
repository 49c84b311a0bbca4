"""Operators against brute force, and on odd tables."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigil.llm import chat, decontaminate, exact, mixing, ngram_join, packing, quality, secrets, suffix, toxicity
from vigil.llm.common import components, ship
from vigil.llm.queries import QUERIES


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


# --- chat ---

def _turns(spark, convs):
    return spark.createDataFrame([(c, k, r, t) for c, turns in convs for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")


def test_chat_round_trip_and_sharing(spark):
    rng = random.Random(2)
    said = ["hi", "<|im_end|>", "a<\\|b", "", "x\ny", "é<|"]
    convs = [(i, [(rng.choice(["user", "assistant", "sys\\\ntem"]), rng.choice(said)) for _ in range(rng.randint(1, 6))]) for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", "5")  # trees cross partitions
    segments, members = chat.format_chats(_turns(spark, convs))
    texts = {(r.tree, r.start): (r.text, r.loss) for r in chat.read_back(segments).collect()}
    for r in members.collect():
        turns = dict(convs)[r.conv]
        text, loss = texts[r.tree, r.start]
        assert chat.parse(text) == turns
        assert "".join(map(chat.unescape, loss)) == "".join(t for role, t in turns if role == "assistant")
    # Each shared turn is written once: as many characters as the trie has.
    trie = {tuple(t[:k + 1]): sum(map(len, chat.pieces(*t[k]))) for _, t in convs for k in range(len(t))}
    rows = segments.collect()
    assert sum(r.length for r in rows) == sum(trie.values())
    by = {}
    for r in rows:
        by.setdefault(r.tree, []).append((r.start, r.start + r.length))
        assert r.position == sum(x.stop - x.segment for x in r.attend)
    for spans in by.values():  # a tree's segments tile its sequence
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_chat_with_ids_nulls_and_empty(spark):
    t = spark.createDataFrame([(1, 0, None, None, "z"), (1, 0, "user", "a", "z"), (1, None, "user", "first", "z"), (None, 0, "user", "p", "z"), (None, 0, "user", "q", "z"), (2, 0, "user", "a" * 50_000, "z")],
                              "conv_id long, turn long, role string, text string, path string")
    segments, members = chat.format_chats(t, encode=lambda s: [ord(c) for c in s])
    assert all("".join(map(chr, r.ids)) == r.text and r.length == len(r.ids) for r in segments.collect())
    assert sorted((r.conv is None, r.n_turns) for r in members.collect()) == [(False, 1), (False, 3), (True, 1), (True, 1)]
    a, b = chat.format_chats(t.where("false"))
    assert a.count() == b.count() == 0


# --- near duplicates ---

def _classes(texts):
    sets = {i: frozenset(w[k:k + 5] if len(w) >= 5 else w for k in range(max(1, len(w) - 4))) if (w := tuple(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))) else frozenset() for i, t in texts.items()}
    near = {i: [j for j in sets if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])] for i in sets}
    out = {}
    for i in sets:
        todo, met = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in met:
                    met.add(j)
                    todo.append(j)
        out[i] = (len(sets[i]), min(met))
    return out


def test_ngram_join_matches_brute_force(spark, words):
    rng = random.Random(8)
    texts = {}
    line = rng.choices(words, k=12)
    for f in range(25):
        base = rng.choices(words, k=rng.randint(8, 60))
        for _ in range(rng.randint(1, 14)):
            w = base[:]
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            if rng.random() < 0.3:
                w = w + line
            texts[len(texts)] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: (r.n, r.component) for r in ngram_join.join_classes(df)[0].collect()}
    assert got == _classes(texts)


def test_ngram_join_odd(spark, odd_docs, no_docs):
    got = ngram_join.join_classes(odd_docs)[0].collect()
    assert len(got) == odd_docs.count()
    by = {r.id: r.component for r in got if r.id is not None}
    assert by[1] == by[2] == by[3] == 1 and by[7] == by[8] == 7 and by[9] == by[10] == 9 and by[4] == 4 and by[5] == 5 and by[6] == 6
    assert ngram_join.join_classes(no_docs)[0].count() == 0


def test_near_duplicates_of_rows_that_share_an_id(spark, words):
    import corpus_pipeline
    rng = random.Random(17)
    a, b, c, d, lone, other = (rng.choices(words, k=60) for _ in range(6))
    near = lambda w: " ".join(w[:30] + ["changed"] + w[31:])
    a, b, c, d, lone, other = ((w, " ".join(w)) for w in (a, b, c, d, lone, other))
    rows = [(1, a[1]), (None, near(a[0])),  # with and without an id
            (None, b[1]), (None, near(b[0])), (None, b[1]),  # none with an id: one stays
            (3, c[1]), (5, near(c[0])), (5, lone[1]),  # 5 has two texts, one of them alone
            (6, d[1]), (6, near(d[0])), (6, d[1]),  # one id, near texts
            (None, other[1]), (7, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sum(t in (b[1], near(b[0])) for _, t in got) == 1 and sum(i == 6 for i, _ in got) == 1
    rest = [x for x in got if x[0] != 6 and x[1] not in (b[1], near(b[0]))]
    assert sorted(map(str, rest)) == sorted(map(str, [(1, a[1]), (3, c[1]), (5, lone[1]), (None, other[1]), (7, None), (None, None)]))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(None, 3)]
    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and root(a) != root(b):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: root(x) for e in edges if e[0] is not None and e[0] != e[1] for x in e}


# --- exact duplicates ---

@pytest.mark.parametrize("bits", [128, 8])  # 8: digests clash, the bytes decide
def test_exact(spark, odd_docs, no_docs, bits):
    rows = odd_docs.select("doc_id", "text").collect()
    rng = random.Random(1)
    more = [(100 + i, "".join(rng.choice("ab \n") for _ in range(rng.choice([0, 3, 9000, 30_000])))) for i in range(40)]
    more += [(200 + i, t + " ") for i, t in more] + [(300 + i, t.replace(" ", "\t\n ")) for i, t in more]
    df = spark.createDataFrame([tuple(r) for r in rows] + more, "doc_id long, text string")
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in [tuple(r) for r in rows] + more:
        groups.setdefault(norm(t), []).append(i)
    want = sorted((str(i), str(min((x for x in g if x is not None), default=None)), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    got = sorted((str(r.id), str(r.keep_id), r.group_size, r.text_sha256) for r in exact.deduplicate(df, digest_bits=bits).collect())
    assert got == want
    assert exact.deduplicate(no_docs).count() == 0


def test_chunks_of_one_digest_in_one_task(monkeypatch):
    monkeypatch.setattr(exact.xxhash, "xxh3_128_digest", lambda body: bytes(16))
    out = list(exact._chunks(iter([pa.RecordBatch.from_arrays([pa.array(["one", "two", "one"])], ["text"])]), 128))
    assert [x["body"] for b in out for x in b.to_pylist()] == [b"one", b"two"]


def test_chunks_depend_on_content():
    rng = np.random.default_rng(3)
    b = rng.integers(97, 123, 200_000).astype(np.uint8)
    a, c = set(exact.cut(b)), {x - 17 for x in exact.cut(np.concatenate((rng.integers(97, 123, 17).astype(np.uint8), b)))}
    assert max(a) == len(b) and len(a & c) > 0.9 * len(a)


# --- suffix arrays ---

def test_suffix_array():
    rng = random.Random(1)
    for k in range(300):
        t = np.array([rng.randint(1, 2 + k % 4) for _ in range(rng.randint(0, 60))] + [0])
        t = np.searchsorted(np.unique(t), t)
        assert suffix.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i, s=t.tolist(): s[i:])
    t = np.append(np.random.default_rng(1).integers(1, 400, 3000), 0)  # more signs than buckets taken at once
    t = np.searchsorted(np.unique(t), t)
    assert suffix.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i, s=t.tolist(): s[i:])


def _removed(texts, k):
    data = [(t or "").encode() for t in texts]
    n = Counter(x[i:i + k] for x in data for i in range(len(x) - k + 1))
    out = []
    for x in data:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - k + 1):
            if n[x[i:i + k]] > 1:
                gone[i:i + k] = True
        out.append((len(x), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), bytes(b for b, g in zip(x, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("key_bytes", [1 << 20, 50])  # 50: every key goes the way of too long ones
def test_remove_repeats(spark, words, key_bytes):
    rng = random.Random(6)
    parts = [" ".join(rng.choices(words, k=rng.randint(2, 12))) for _ in range(30)]
    texts = [" ".join(rng.choice(parts) if rng.random() < 0.5 else " ".join(rng.choices(words, k=6)) for _ in range(rng.randint(0, 8))) for _ in range(60)] + [None, "", "ab" * 200, "x" * 90, "é" * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix.remove_repeats(df, length=40, gram=13, key_bytes=key_bytes, shard_bytes=2000).collect()
    assert sorted((r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == _removed(texts, 40)


def test_remove_repeats_odd(spark, odd_docs, no_docs):
    short = odd_docs.where("doc_id is null or doc_id not in (9, 10)")
    got = suffix.remove_repeats(short).collect()
    assert sorted((r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == _removed([r.text for r in short.collect()], 400)
    pair = {r.id: r.n_bytes - r.n_removed for r in suffix.remove_repeats(odd_docs.where("doc_id in (9, 10)")).collect()}
    assert pair == {9: 0, 10: 0}
    assert suffix.remove_repeats(no_docs).count() == 0


def test_repeated_with_rare_signs():
    def brute(texts, k):
        n = Counter(x[i:i + k] for x in texts for i in range(len(x) - k + 1))
        return [[i for i in range(len(x) - k + 1) if n[x[i:i + k]] > 1] for x in texts]
    assert [x.tolist() for x in suffix.repeated([b"yabc", b"xabc"], 3)] == [[1], [1]]
    rng = random.Random(14)
    for _ in range(400):
        parts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 9))) for _ in range(3)]
        rare = iter(rng.sample(range(256), 60) * 2)  # signs that occur once or twice
        texts = [b"".join(bytes([next(rare)]) * rng.randint(0, 1) + rng.choice(parts) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 6))]
        k = rng.randint(1, 8)
        assert [x.tolist() for x in suffix.repeated(texts, k)] == brute(texts, k)


def test_planted_passages_are_told_by_bytes_removed(spark, tmp_path):
    rng = random.Random(23)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(n))
    text = lambda n, size: " ".join(word(size) for _ in range(n))
    long, short = text(60, 8), text(60, 4)  # both of over 50 words; the second has fewer bytes than a string
    assert len(short.encode()) < suffix.LENGTH < len(long.encode())
    around = lambda x: f"{text(40, 6)} {x} {text(40, 6)}"
    kinds = {"long": [around(long) for _ in range(5)], "short": [around(short) for _ in range(5)], "clean": [text(150, 6) for _ in range(5)] + [None, ""]}
    rows = [(i, k, t) for i, (k, t) in enumerate((k, t) for k, ts in kinds.items() for t in ts)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op5_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert sorted(got) == [i for i, _, _ in rows]
    for i, kind, t in rows:
        assert got[i].n_bytes == len((t or "").encode())  # of the input, planted or not
        assert (got[i].n_removed > 0) == (kind == "long")
        if kind == "long":
            assert got[i].n_removed >= len(long.encode())
    plain = sorted((n, gone, spans, hashlib.sha256(kept).hexdigest()) for n, gone, spans, kept in _removed([t for _, _, t in rows], suffix.LENGTH))
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.values()) == plain


# --- secrets ---

def test_secrets_finds_random_strings(spark, odd_docs, no_docs):
    rng = random.Random(7)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(i, f"set password = {key(24)} here") for i in range(80)] + [(100 + i, "the " + "".join(rng.choice(["an", "tion", "er", "in", "the", "es"]) for _ in range(8)) + " word") for i in range(80)]
    rows += [(200, f"é plain {key(32)} text"), (201, "secret: short"), (202, "AKIA" + "Q" * 16 + " api_key='abcdefghijkl' " + "0123456789abcdef0"), (203, None)]
    got = {r.id: [(s.kind, s.start, s.stop) for s in r.spans] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == [("assign", 4, 39)] and got[200] == [("markov", 8, 40)] and got[201] == [] and got[203] == []
    assert got[202] == [("access", 0, 20), ("assign", 21, 42), ("hex", 44, 61)]
    assert not any(got[100 + i] for i in range(80))
    assert secrets.scan(odd_docs).count() == odd_docs.count() and secrets.scan(no_docs).count() == 0


# --- mixing ---

def test_targets_and_bounds(spark, odd_docs, no_docs):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 40), rng.choices(["a", "b", "c", None, "tiny"], [40, 30, 20, 9, 1])[0]) for i in range(800)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep_text=False).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r.mix_source] += r.mix_size
        taken[r.mix_source] += r.mix_size * r.mix_times
        target[r.mix_source] = r.mix_target
        assert r.mix_times <= 2
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert target[s] <= 2 * sizes[s] + 1e-6 and abs(taken[s] - target[s]) <= 80
    served = mixing.serve(mixing.mix(odd_docs))
    assert served.select("row.*").columns == odd_docs.columns and served.count() > 0
    assert mixing.serve(mixing.mix(no_docs)).count() == 0
    assert mixing.mix(odd_docs).count() == odd_docs.count()


def _hot(spark):
    """A third of the rows without id and of one size, a third that repeat one id, and equal rows among both."""
    rows = [(None, f"w{i % 400} " * 7, "b") for i in range(600)] + [(1, f"x{i % 3} " * 7, "b") for i in range(600)] + [(10 + i, "y " * (i % 30 + 1), "a" if i % 2 else "b") for i in range(600)]
    return spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, key int")


def test_each_copy_has_its_own_place(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    docs = _hot(spark).repartition(5)
    mixed = mixing.mix(docs, keep_text=False).collect()
    taken, target = Counter(), {}
    for r in mixed:
        taken[r.mix_source] += r.mix_size * r.mix_times
        target[r.mix_source] = r.mix_target
    assert len(mixed) == docs.count() and all(abs(taken[s] - target[s]) <= 30 for s in target)
    whole = mixing.mix(docs)
    assert sorted((r.row.doc_id or -1, r.mix_size, r.mix_times) for r in whole.collect()) == sorted((r.mix_id or -1, r.mix_size, r.mix_times) for r in mixed)
    assert Counter(r.row for r in whole.collect()) == Counter(docs.collect())
    again = mixing.mix(docs.repartition(3), keep_text=False).collect()
    assert Counter(again) == Counter(mixed)  # however the rows come


def test_hot_rows_fill_many_shards(spark):
    sizes = [r.n for r in packing.pack(_hot(spark), row_tokens=64, shard_bytes=1024).groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()]
    assert len(sizes) >= 20 and max(sizes) < 4 * sum(sizes) / len(sizes)
    empty = spark.createDataFrame([(i, None) for i in range(640)], "doc_id long, text string")
    assert packing.pack(empty, row_tokens=64, shard_bytes=1024).select("shard").distinct().count() >= 8


# --- decontamination ---

def test_decontaminate_odd_and_short_items(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (2, "TWO"), (3, None), (4, "..."), (5, "a a a a a a a a a a a a"), (6, "w5 w6 w7")], "item_id long, text string")
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame([(50, "b " + "a " * 13 + "b"), (51, "a " * 9)], "doc_id long, text string"))
    got = {r.doc: (r.n_hit, r["items"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: (10, ["1", "6"]), 2: (10, ["1", "6"]), 3: (10, ["1", "6"]), 7: (1, ["2"]), 8: (1, ["2"]), 50: (13, ["5"])}
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("false")).count() == 0


def test_decontaminate_matches_without_broadcast(spark, odd_docs, monkeypatch):
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12")], "item_id long, text string")
    a = sorted(map(str, decontaminate.decontaminate(odd_docs, bench).collect()))
    monkeypatch.setattr("vigil.llm.common.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert a and sorted(map(str, decontaminate.decontaminate(odd_docs, bench).collect())) == a
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_decontaminate_rows_that_share_an_id(spark, tmp_path):
    import corpus_pipeline
    from vigil.llm.queries import QUERIES
    a, b = (" ".join(f"{c}{i}" for i in range(10)) for c in "ab")
    rows = [(None, "x " + a), (None, "clean one"), (None, "clean two"), (None, None), (1, b + " y z"), (1, "x " + a), (1, "clean"), (1, "x " + a), (2, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, a), (2, b)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op9_decontaminate"](spark, str(tmp_path)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len((t or "").split()), 10 * h, h, sha("1" if a in (t or "") else "2" if h else "")) for i, t in rows for h in [int(a in (t or "") or b in (t or ""))]]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256)) for r in got)
    left = corpus_pipeline.without_benchmarks(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()
    assert sorted(map(str, left)) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in rows if a not in (t or "") and b not in (t or ""))


# --- classifiers ---

def _labelled(spark, words):
    rng = random.Random(12)
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        w = rng.choices(words[:200], k=60)
        if bad:
            w = [x + rng.choice(["###", "&&&"]) for x in w]
        rows.append((i, " ".join(w), 0 if bad else 1))
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows] + [(9999, 1), (None, 0), (3, None)], "doc_id long, quality int")


def test_quality_learns_and_repeats(spark, words):
    docs, labels = _labelled(spark, words)
    got = {r.id: r.score for r in quality.score(docs, labels).collect()}
    assert sum((got[i] >= 0.5) != (i % 4 != 0) for i in got) <= 6 and all(0 <= s <= 1 for s in got.values())
    again = {r.id: r.score for r in quality.score(docs.repartition(3), labels).collect()}
    assert max(abs(got[i] - again[i]) for i in got) < 1e-3


def test_classifiers_on_odd_tables(spark, odd_docs, no_docs, words):
    _, labels = _labelled(spark, words)
    toxic = labels.withColumnRenamed("quality", "toxic")
    assert quality.score(odd_docs, labels).count() == odd_docs.count()
    kept = quality.score(odd_docs, labels.where("false"), keep=True)
    assert kept.select("row.*").columns == odd_docs.columns and {r.score for r in kept.collect()} == {0.5}
    assert quality.score(no_docs, labels).count() == 0
    assert toxicity.score(odd_docs, toxic).count() == odd_docs.count()
    assert toxicity.score(odd_docs, toxic.where("false")).count() == odd_docs.count()
    assert toxicity.score(no_docs, toxic).count() == 0


def test_toxicity_chain(spark, words):
    rng = random.Random(21)
    rows = [(i, " ".join(rng.choices(words, k=40) + (rng.choices(["vileword", "rudeterm"], k=2) if i % 5 == 0 else ["achtung" + x for x in rng.choices(words, k=3)] if i % 5 == 1 else [])), int(i % 5 < 2)) for i in range(800)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.id: r for r in toxicity.score(docs, labels).collect()}
    assert sum((r.toxic >= 0.5) != (i % 5 < 2) for i, r in got.items()) <= 8
    assert all(0 <= p <= 1 for r in got.values() for p in (r.explicit, r.implicit, r.toxic))


# --- packing ---

def test_best_fit_decreasing_matches_plain_search():
    rng = random.Random(11)
    for _ in range(60):
        most = rng.randint(1, 40)
        lengths = [rng.randint(0, most) for _ in range(rng.randint(0, 80))]
        free = []
        for n in sorted(lengths, reverse=True):
            fits = [f for f in free if f >= n]
            if fits:
                free[free.index(min(fits))] -= n
            else:
                free.append(most - n)
        rows = packing.best_fit_decreasing(lengths, most)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(most - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def test_tokens_round_trip(spark, odd_docs, no_docs):
    with open(packing.VOCABULARY, "rb") as f:
        t = packing.Tokenizer(f.read())
    odd = ["", " ", "a  b", "a b ", " a b", "x\n y", "x \n\ty z", "it's we'll 12 ab3!!  ?", "é  ü z", "a  b", "tab\t one", "q   w"]
    for text in odd:
        assert np.frombuffer(t.encode(text), t.dtype).tolist() == t.own.encode_ordinary(text), repr(text)
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack(docs, row_tokens=64, shard_bytes=20_000)
    back = {r.doc_id: t.own.decode(np.frombuffer(r.input_ids, t.dtype).tolist()) for r in packing.unpack(rows).collect()}
    assert back == {r.doc_id: r.text or "" for r in docs.collect()}
    for r in packing.position_ids(rows).collect():
        assert r.cu_seqlens[-1] == r.n_tokens == len(r.position_ids) and all(r.position_ids[i] == 0 for i in r.position_resets if i < r.n_tokens)
    assert packing.pack(odd_docs, row_tokens=64).agg(F.sum(F.size("doc_ids"))).first()[0] >= odd_docs.count()
    assert packing.pack(no_docs).count() == 0
