"""Runs of words that repeat with a period, found by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``max(24, 3 * q)`` long, that no neighbouring word extends.
The documents of a batch stand one behind another in one array of words; words of different documents never match.

1. Dyadic names: rounds of doubling name every block of 1, 2, 4, ... words, so that blocks are equal when their names are.
   A name is the first place of its class in the suffix array, which the rounds complete; only places whose block is still
   shared go on to the next round. Names also give the longest common extension of two places, both ways, in one descent.
2. Occurrences: a run whose period lies in b .. 2b - 1 (b a power of two, 8 at least) holds an aligned block of b words that
   comes again q places on. The block's class is an interval of the suffix array, and a wavelet tree over that array answers
   how many of its members lie in the neighbouring window of b places, and which is next. A window of eight places from the
   block on gives the periods below eight: there the next occurrence is the period.
3. Progressions: one or two occurrences are candidates as they are. Three or more form a progression whose difference d is the
   block's own period; a longer period can then only shift the whole stretch of period d, so the distances of the ends and
   of the starts of the two stretches are the candidates.
4. A candidate is extended both ways; it is a run if it is long enough. Of several periods of one stretch the least stays.

Names are exact, so nothing is left to verify. Each document is one row in one task; memory is proportional to the longest
document (or to ``CHUNK_WORDS``), time to n log n. Nothing is shuffled.

Defined results: null, empty and blank texts have no words and no runs; rows without id, repeated rows and extra columns are
carried row by row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words looked at together; a longer document is looked at alone.
CHUNK_WORDS = 200_000
#: The smallest block is 2 ** BASE words: a third of ``LEAST_WORDS``.
BASE = 3


class Wavelet:
    """A wavelet tree, kept by levels, over the values 0 .. n - 1: counts below a bound and k-th smallest of intervals."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, len(values).bit_length())
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for b in reversed(range(self.bits)):
            bit = (values >> b) & 1
            ones = np.concatenate(([0], np.cumsum(bit)))
            self.levels.append((b, ones, len(values) - int(ones[-1])))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lo), dtype=np.int64)
        for b, ones, zeros in self.levels:
            up, l1, h1 = (bound >> b) & 1 == 1, ones[lo], ones[hi]
            out += np.where(up, (hi - h1) - (lo - l1), 0)
            lo, hi = np.where(up, zeros + l1, lo - l1), np.where(up, zeros + h1, hi - h1)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lo), dtype=np.int64)
        for _, ones, zeros in self.levels:
            l1, h1 = ones[lo], ones[hi]
            left = (hi - h1) - (lo - l1)
            up = k >= left
            k = np.where(up, k - left, k)
            lo, hi = np.where(up, zeros + l1, lo - l1), np.where(up, zeros + h1, hi - h1)
            out = 2 * out + up
        return out


def _starts(a: np.ndarray) -> np.ndarray:
    """Flags where a sorted array changes; the first place counts."""
    return np.concatenate(([True], a[1:] != a[:-1])) if len(a) else np.zeros(0, bool)


def _spread(starts: np.ndarray) -> np.ndarray:
    """For each place the place where its group starts."""
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))


class Names:
    """Names of all dyadic blocks, and the intervals of the suffix array that shared blocks of ``2 ** BASE`` words or more have."""

    def __init__(self, words: np.ndarray, docs: np.ndarray):
        n = len(words)
        self.n = n
        ends = np.searchsorted(docs, docs, "right")  # of each place's document
        key = docs * (int(words.max()) + 1) + words
        rank, active, first = np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64)
        self.names: list[np.ndarray] = []
        self.shared: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # by level: places, interval start, interval end
        level = 0
        while True:
            order = np.argsort(key, kind="stable")
            at, own = active[order], _spread(_starts(key[order]))
            new = first[order] + own - _spread(_starts(first[order]))
            rank[at] = new
            size = np.bincount(own, minlength=len(own))[own] if len(own) else own
            many = size > 1
            active, first, size = at[many], new[many], size[many]
            if level == BASE:  # from here on only these places count: their ranks close up, all others get names of their own
                self.places = np.sort(active)
                by = np.argsort(first, kind="stable")
                active, size, first = active[by], size[by], _spread(_starts(first[by]))
                rank = len(active) + np.arange(n)
                rank[active] = first
            self.names.append(rank.astype(np.int32 if 2 * n < 1 << 31 else np.int64))
            if level >= BASE:
                self.shared[level] = (active, first, first + size)
            if not len(active):
                break
            nxt = active + (1 << level)
            inside = nxt < ends[active]
            second = np.where(inside, rank[np.minimum(nxt, n - 1)] + 1, 0)
            key = first * (2 * n + 2) + second
            level += 1
        if level >= BASE:
            self.suffixes = rank  # each shared place has its place in the suffix array
        else:
            self.places = np.zeros(0, np.int64)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from ``i`` and ``j`` (``i`` < ``j``) on."""
        i, start = i.copy(), i
        gap = j - i
        for level in reversed(range(len(self.names))):
            names, j = self.names[level], i + gap
            same = (j < self.n) & (names[np.minimum(i, self.n - 1)] == names[np.minimum(j, self.n - 1)])
            i += same * (1 << level)
        return i - start

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree before ``i`` and ``j``."""
        i, start = i.copy(), i
        gap = j - i
        for level in reversed(range(len(self.names))):
            names, p = self.names[level], i - (1 << level)
            same = (p >= 0) & (names[np.maximum(p, 0)] == names[np.maximum(p, 0) + gap])
            i -= same * (1 << level)
        return start - i


def _candidates(names: Names) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods: every run has one at a place inside it."""
    places = names.places
    tree = Wavelet(np.argsort(names.suffixes[places], kind="stable"))
    xs, qs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for level, (x, lo, hi) in names.shared.items():
        b = 1 << level
        aligned = x % b == 0
        x, lo, hi = x[aligned], lo[aligned], hi[aligned]

        def count(to: np.ndarray, lo: np.ndarray = lo, hi: np.ndarray = hi) -> np.ndarray:
            return tree.below(lo, hi, np.searchsorted(places, to))

        def nth(k: np.ndarray, some: np.ndarray, lo: np.ndarray = lo, hi: np.ndarray = hi) -> np.ndarray:
            return places[tree.smallest(lo[some], hi[some], k[some])]

        here, end = count(x + b), count(x + 2 * b)
        n = end - here
        if level == BASE:
            k = count(x + 1)
            some = here > k
            xs.append(x[some])
            qs.append(nth(k, some) - x[some])
        for more in (0, 1):
            some = (n > more) & (n < 3)
            xs.append(x[some])
            qs.append(nth(here + more, some) - x[some])
        some = n > 2
        y, t = x[some], nth(here, some)
        d = nth(here + 1, some) - t
        for q in (t + names.forward(t, t + d) - y - names.forward(y, y + d), t - names.backward(t, t + d) - y + names.backward(y, y + d)):
            fits = (q >= b) & (q < 2 * b)
            xs.append(y[fits])
            qs.append(q[fits])
    return np.concatenate(xs), np.concatenate(qs)


def find_runs(words: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start, then period. ``words`` are numbers (equal: the same word) of the
    documents ``docs`` (numbers, ascending); starts are places of ``words``."""
    none = np.zeros(0, np.int64)
    if len(words) < LEAST_WORDS:
        return none, none, none
    names = Names(words.astype(np.int64), docs.astype(np.int64))
    if not len(names.places):
        return none, none, none
    x, q = _candidates(names)
    start = x - names.backward(x, x + q)
    length = x + q + names.forward(x, x + q) - start
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    start, length, q = start[long], length[long], q[long]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[least], length[least], q[least]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def _chunks(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    out, n = [], 0
    for text in texts:
        words = (text or b"").split()  # bytes split at 0x20 and 0x09 to 0x0D
        if out and n + len(words) > CHUNK_WORDS:
            yield out
            out, n = [], 0
        out.append(words)
        n += len(words)
    yield out


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for docs in _chunks(batch.column(1).cast(pa.binary()).to_pylist()):
            number: dict[bytes, int] = {}
            codes = np.array([number.setdefault(w, len(number)) for words in docs for w in words], dtype=np.int64)
            sizes = np.array([len(words) for words in docs], dtype=np.int64)
            first = np.cumsum(sizes) - sizes
            start, length, period = find_runs(codes, np.repeat(np.arange(len(docs)), sizes))
            of = np.searchsorted(first + sizes, start, "right")
            edge = np.zeros(len(codes) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            keep = np.cumsum(edge)[:-1] == 0
            runs: list[list[dict]] = [[] for _ in docs]
            for d, s, n, q in zip(of.tolist(), (start - first[of]).tolist(), length.tolist(), period.tolist(), strict=True):
                runs[d].append({"start": s, "length": n, "period": q})
            left = [b" ".join(words if not r else [w for w, k in zip(words, keep[f: f + len(words)].tolist(), strict=True) if k])
                    for words, r, f in zip(docs, runs, first.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(docs)), pa.array(sizes), pa.array(runs, pa.list_(RUN)), pa.array(left, pa.binary()).cast(pa.string())],
                ["id", "n_words", "runs", "collapsed"])
            at += len(docs)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, runs`` (``start, length, period`` in words, by start, then period) and ``collapsed``: the words that
    no run holds behind its first period, joined by one blank."""
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    return two.mapInArrow(_find, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
