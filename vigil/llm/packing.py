"""Token ids, packed into fixed-length rows by best fit decreasing.

Documents are tokenised in Arrow batches; a document longer than a row is split into pieces that together are the
document, nothing lost. Pieces are dealt to shards by a hash of document, piece and the row's number in its task, so one long document, a group of
copies or rows of one id fill many shards, and a shard holds a bounded number of bytes. A shard packs its pieces longest first, each into
the fullest row that still has room for it; rows are found by their free space in a segment tree. Rows are written with
their ids as little-endian binary, the cumulative lengths of their segments, and the places where positions restart.

Defined results: null or empty texts are segments of length 0; repeated rows are packed as often as they come; a null
id is carried as null; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how the public byte-level vocabulary cuts texts before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ROW_TOKENS, SHARD_BYTES = 2048, 8 << 20
#: Words whose ids a task remembers, some 10 MB; it starts with none and lets go of them when it ends.
WORDS_KEPT = 50_000


class Tokenizer:
    """Byte-level BPE with a memory of words. The pattern never joins what stands before a space and a following
    non-space, so a text can be encoded word by word; texts with other white space take the plain way."""

    def __init__(self, ranks: bytes):
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.dtype = np.dtype("<u2" if len(merges) < 65536 else "<u4")
        self.words: dict[str, bytes | None] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.own.encode_ordinary(text), dtype=self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        words, out = self.words, []
        for w in rest:
            ids = words.get(w)
            if ids is None:
                if not w or w[0].isspace():
                    return self._plain(text)
                ids = words[w] = self._plain(" " + w)
            out.append(ids)
        if len(words) > WORDS_KEPT:  # forgetting only encodes a word again
            words.clear()
        return self._plain(first) + b"".join(out)


def _pieces(batches: Iterator[pa.RecordBatch], ranks: bytes, row: int, shards: int) -> Iterator[pa.RecordBatch]:
    t, task, rows = Tokenizer(ranks), TaskContext.get().partitionId(), 0
    step = row * t.dtype.itemsize
    for batch in batches:
        ids, piece, body, shard = [], [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = t.encode(text or "")
            rows += 1
            for k in range(max(1, -(-len(data) // step))):
                ids.append(key)
                piece.append(k)
                body.append(data[k * step: (k + 1) * step])
                h = hashlib.blake2b(f"{key}:{k}:{task}:{rows}".encode(), digest_size=8).digest()
                shard.append(int.from_bytes(h, "little") % shards)
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(ids, batch.schema.field(0).type), pa.array(piece, pa.int32()), pa.array(body, pa.binary())], ["shard", "id", "piece", "body"])


class Space:
    """Rows by free space: a segment tree over 0..most that counts the rows with each free space."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def put(self, free: int, row: int) -> None:
        self.rows.setdefault(free, []).append(row)
        self._add(free, 1)

    def _add(self, free: int, by: int) -> None:
        i = self.size + free
        while i:
            self.count[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least free space of at least ``need``, taken out, and that space."""
        i, count = self.size + need, self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):  # up to where something lies to the right
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        free = i - self.size
        self._add(free, -1)
        return self.rows[free].pop(), free


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Indexes of ``lengths`` (none above ``most``) by row, each row in the order it was filled."""
    rows: list[list[int]] = []
    space = Space(most)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = space.take(lengths[i])
        if found is None:
            rows.append([])
            found = (len(rows) - 1, most)
        rows[found[0]].append(i)
        space.put(found[1] - lengths[i], found[0])
    return rows


def _pack(table: pa.Table, row: int, width: int, pad: int) -> pa.Table:
    body = table.column("body").to_pylist()
    # In a fixed order, however the pieces came.
    order = sorted(range(len(body)), key=lambda i: (table["id"][i].as_py() is None, table["id"][i].as_py() or 0, table["piece"][i].as_py(), body[i]))
    table, body = table.take(order), [body[i] for i in order]
    ids, piece, shard = table["id"].to_pylist(), table["piece"].to_pylist(), table["shard"][0].as_py()
    filler = int(pad).to_bytes(width, "little")
    out = []
    for k, members in enumerate(best_fit_decreasing([len(b) // width for b in body], row)):
        sums = np.cumsum([0] + [len(body[i]) // width for i in members]).tolist()
        data = b"".join(body[i] for i in members)
        out.append((shard, k, data + filler * (row - len(data) // width), sums[-1], sums, sums[:-1], [ids[i] for i in members], [piece[i] for i in members]))
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(table.schema.field("id").type), pa.list_(pa.int32())]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], NAMES)


NAMES = ["shard", "row", "input_ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "pieces"]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, row_tokens: int = ROW_TOKENS, shard_bytes: int = SHARD_BYTES, pad: int = 0) -> DataFrame:
    """Rows of ``row_tokens`` ids: ``shard, row, input_ids`` (binary, 2 bytes an id, or 4 if the vocabulary needs them),
    ``n_tokens`` (the rest is ``pad``), ``cu_seqlens, position_resets, doc_ids, pieces`` (which piece of its document).
    The vocabulary file is read by the driver and sent along; it is of fixed size."""
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    width = Tokenizer(ranks).dtype.itemsize
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    octets = two.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(16))).first()[0] or 0
    shards = max(1, -(-int(octets) // shard_bytes))
    ranks_of = docs.sparkSession.sparkContext.broadcast(ranks)
    pieces = two.mapInArrow(lambda it: _pieces(it, ranks_of.value, row_tokens, shards), f"shard int, id {kind}, piece int, body binary")
    return pieces.groupBy("shard").applyInArrow(
        lambda t: _pack(t, row_tokens, width, pad),
        f"shard int, row long, input_ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<{kind}>, pieces array<int>")


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet; each row's ids are one binary value of fixed length."""
    packed.write.parquet(path)


def position_ids(packed: DataFrame) -> DataFrame:
    """Adds ``position_ids``: 0, 1, 2 ... from each reset."""
    spans = F.zip_with("position_resets", F.slice("cu_seqlens", 2, F.size("position_resets")), lambda a, b: F.when(b > a, F.sequence(F.lit(0), b - a - 1)).otherwise(F.array().cast("array<int>")))
    return packed.withColumn("position_ids", F.flatten(spans))


def unpack(packed: DataFrame, width: int = 2) -> DataFrame:
    """``doc_id, input_ids``: the whole documents again, from their pieces (ids that are not repeated)."""
    seg = packed.select("input_ids", F.explode(F.arrays_zip("doc_ids", "pieces", "position_resets", F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("ends"))).alias("s"))
    at, to = F.col("s.position_resets"), F.col("s.ends")
    seg = seg.select(F.col("s.doc_ids").alias("doc_id"), F.struct(F.col("s.pieces").alias("k"), F.hex(F.substring("input_ids", at * width + 1, (to - at) * width)).alias("b")).alias("p"))
    return seg.groupBy("doc_id").agg(F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["b"]), "")).alias("input_ids"))
