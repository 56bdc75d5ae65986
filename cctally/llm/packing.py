"""Operator 11: documents packed into token sequences along a space-filling curve.

1. A narrow pass encodes every text with a byte-level BPE file of the
   ``tokenizers`` library (nothing is trained) and adds the end id. The ids
   are hashed into a document vector, which a fixed random projection takes to
   ``DIMS`` dimensions; their Hilbert index is the document's place on the
   curve. Ids and places are written once.
2. The places, without the ids, are range-sorted by Hilbert key and summed up:
   every document's first id gets its position in one long row of all ids.
   Documents of one key, such as copies, are ordered by a hash, so that they
   spread over the sort's tasks.
3. Positions return to the ids by row number, evenly dealt, and each document
   is cut where its ids pass from one sequence to the next. Neighbours on the
   curve share sequences.

All sequences are full but those of the last ``length - 1`` ids at most, which
form sequences of descending powers of two. So no sequence is padded, and no
task holds more than a batch of documents.

A text is encoded by its chunks (white space and what follows it up to the
next white space); the library's pattern never matches across their borders,
so a distinct chunk is encoded once per worker. The cache is emptied when it
is full; results do not depend on it. Texts with other white space than
ASCII's, or with the string of a special token, go to the library whole.

Defined results: a null text is empty and has one id, the end. Null and
repeated doc_ids are packed row by row. Columns other than ``doc_id`` and
``text`` are not read. An empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cctally.llm.bpe import byte_letters
from cctally.llm.common import mix, slices, stage

LENGTH, END = 2048, 1
#: Hashed vector size, dimensions of the curve and bits of each.
VECTOR, DIMS, BITS = 512, 4, 10
#: Distinct chunks that a worker remembers, and bytes of text of one step.
CACHE_CHUNKS, STEP_BYTES = 1_500_000, 8_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: White space outside ASCII, and controls that some libraries count as such.
_ODD_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


class ChunkEncoder:
    """Token ids of texts, by a bounded cache of the ids of distinct chunks."""

    def __init__(self, spec: str):
        import tiktoken
        from tokenizers import Tokenizer

        plain = json.loads(spec)
        kinds = plain["pre_tokenizer"], plain["normalizer"], plain["post_processor"]
        model = plain["model"]
        if (kinds[0] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
                or kinds[1] is not None or model["type"] != "BPE" or model["dropout"] or model["unk_token"]):
            raise ValueError("this tokenizer file uses parts that are not supported")
        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = [a["content"] for a in plain["added_tokens"]]
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in self.special}
        made = [ranks[bytes(map(byte.__getitem__, "".join(m if isinstance(m, list) else m.split(" "))))]
                for m in model["merges"]]
        if made != sorted(set(made)) or len(made) + 256 != len(ranks):
            raise ValueError("ids that do not follow the merges are not supported")
        # the same merges by rank; the library itself takes five times as long
        self.quick = tiktoken.Encoding("chunks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.ends = [0]

    def _learn(self, chunks: list[bytes]) -> None:
        if len(self.place) + len(chunks) > CACHE_CHUNKS:
            self.forget()
        for chunk in chunks:
            ids = self.quick.encode_ordinary(chunk.decode("utf-8"))
            stop = self.ends[-1] + len(ids)
            if stop > len(self.flat):
                self.flat = np.resize(self.flat, 2 * stop)
            self.flat[self.ends[-1]:stop] = ids
            self.place[chunk] = len(self.ends) - 1
            self.ends.append(stop)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        for word in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, word))
        odd = odd.to_numpy(zero_copy_only=False)
        ids, count = self._encode_plain(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)
                                        if odd.any() else texts)
        if odd.any():
            found = [e.ids for e in self.whole.encode_batch(
                texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)]
            ends = np.cumsum(count)[odd]
            ids = np.insert(ids, np.repeat(ends, [len(x) for x in found]),
                            np.concatenate([np.asarray(x, np.uint32) for x in found]))
            count = count.copy()
            count[odd] = [len(x) for x in found]
        return ids, count

    def _encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
        data = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        space = _SPACE[data]
        begins = np.zeros(len(data), bool)
        begins[1:] = space[1:] & ~space[:-1]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(begins)
        bounds = np.r_[start, len(data)]
        chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.place]
        if len(self.place) + len(new) > CACHE_CHUNKS:
            new = distinct
        self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        ends = np.array(self.ends, np.int64)
        code = chunks.indices.to_numpy()
        first, size = ends[at][code], (ends[at + 1] - ends[at])[code]
        stop = np.cumsum(size)
        ids = self.flat[np.repeat(first - stop + size, size) + np.arange(stop[-1])]
        total = np.r_[0, stop][np.searchsorted(start, offsets)]
        return ids, np.diff(total)


#: Fixed value: the split pattern of the byte-level pre-tokenizer of the library.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ENCODERS: dict[int, ChunkEncoder] = {}


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """The index on the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate.

    Gray-code transform of the coordinates in place, highest bit first, after
    J. Skilling, "Programming the Hilbert curve" (2004); vectorised over points.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(dims):
            set_ = (x[k] >> bit) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[k] ^= swap
    for k in range(1, dims):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(dims):
            key = (key << 1) | ((x[k] >> bit) & 1)
    return key


def curve_keys(ids: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Hilbert keys of documents: hashed counts of ids, scaled to length one, projected and cut into cells."""
    sign = np.where(np.arange(VECTOR) % 2, 1.0, -1.0)
    bucket = (mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(VECTOR)).astype(np.int64)
    project = np.random.default_rng(11).standard_normal((VECTOR, DIMS)) * sign[:, None]
    out = np.empty(docs, np.int64)
    step = 2048
    bounds = np.searchsorted(doc, np.arange(0, docs + step, step))
    for k, first in enumerate(range(0, docs, step)):
        n = min(step, docs - first)
        part = slice(bounds[k], bounds[k + 1])
        vector = np.bincount((doc[part] - first) * VECTOR + bucket[part], minlength=n * VECTOR).reshape(n, VECTOR)
        vector = np.sqrt(vector)
        norm = np.sqrt((vector ** 2).sum(1, keepdims=True))
        place = vector / np.maximum(norm, 1) @ project  # about normal in each dimension
        cell = 1 / (1 + np.exp(-1.702 * place)) * (1 << BITS)
        out[first:first + n] = hilbert(np.clip(cell, 0, (1 << BITS) - 1), BITS)
    return out


_ENCODED = "doc_id long, ids binary, n long, key long, tie long"


def _encode(spec: str, end: int):
    digest = hash(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(digest)
        if encoder is None:
            _ENCODERS.clear()
            encoder = _ENCODERS[digest] = ChunkEncoder(spec)
        for batch in batches:
            for first, texts in slices(batch.column(1), STEP_BYTES):
                ids, count = encoder.encode(texts)
                stop = np.cumsum(count)
                ids = np.insert(ids, stop, end)
                count = count + 1
                stop = np.cumsum(count)
                doc = np.repeat(np.arange(len(count)), count)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(texts)), _binary(ids, stop), pa.array(count, pa.int64()),
                    pa.array(curve_keys(ids, doc, len(count))),
                    batch.column(2).slice(first, len(texts))], names=["doc_id", "ids", "n", "key", "tie"])
    return run


def _binary(ids: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Each document's ids as little-endian numbers of 32 bits."""
    return pa.Array.from_buffers(pa.large_binary(), len(stop), [
        None, pa.py_buffer(np.r_[0, stop * 4].astype(np.int64)), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())


def encode(docs: DataFrame, tokenizer_path: str, end: int = END) -> DataFrame:
    """``doc_id, row, ids, n, key, tie`` of every document, written once; ``row`` is a number of its own."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("tie", F.xxhash64(F.col("doc_id"), F.length("text")))
    encoded = source.mapInArrow(_encode(spec, end), _ENCODED)
    return stage(encoded.withColumn("row", F.monotonically_increasing_id()), "packing_ids")


def positions(encoded: DataFrame) -> DataFrame:
    """``row, position``: where each document's first id lies in the one long row of ids along the curve."""
    placed = encoded.select("row", "key", "tie", "n").orderBy("key", "tie", "row").select(
        "row", "n", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = stage(placed.withColumn("chunk", F.shiftright("at", 12)), "packing_order")
    # sums of bounded runs of rows, then of the runs; a run lies in one partition of the sort
    runs = placed.groupBy("part", "chunk").agg(F.sum("n").alias("run"))
    before = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("in_part", F.coalesce(F.sum("run").over(before), F.lit(0)))
    parts = placed.groupBy("part").agg(F.sum("n").alias("size")).select("part", F.coalesce(F.sum("size").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    runs = runs.join(parts, "part")  # one row per partition of the sort
    within = Window.partitionBy("part", "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("in_run", F.coalesce(F.sum("n").over(within), F.lit(0))).join(runs, ["part", "chunk"])
            .select("row", (F.col("before") + F.col("in_part") + F.col("in_run")).alias("position")))


def sequence_bounds(total: int, length: int) -> list[int]:
    """Starts of the sequences after the last full one: descending powers of two, none padded."""
    at = total - total % length
    bounds = [at]
    for bit in range(length.bit_length() - 1, -1, -1):
        if total % length >> bit & 1:
            at += 1 << bit
            bounds.append(at)
    return bounds


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "ids binary")


def _cut(length: int, bounds: list[int], keep_ids: bool):
    tail = np.array(bounds, np.int64)
    full = bounds[0] // length

    def sequences(at: int, stop: int) -> np.ndarray:
        """Starts of the sequences that begin strictly between two positions."""
        inner = np.arange(at // length + 1, min(-(-stop // length), full + 1), dtype=np.int64) * length
        return np.r_[inner, tail[1:][(tail[1:] > at) & (tail[1:] < stop)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, ids, n, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                                       batch.column(3).to_pylist(), strict=True):
                data = memoryview(ids.as_buffer())
                cuts = sequences(at, at + n)
                starts = np.r_[at, cuts].tolist()
                for a, b in zip(starts, [*starts[1:], at + n], strict=True):
                    if a < tail[0]:
                        number, head = a // length, a // length * length
                    else:
                        k = int(np.searchsorted(tail, a, side="right")) - 1
                        number, head = full + k, int(tail[k])
                    piece = data[4 * (a - at):4 * (b - at)]
                    rows.append((doc, a - at, b - a, zlib.crc32(piece), n, number, a - head,
                                 bytes(piece) if keep_ids else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            types = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=[x.split()[0] for x in _PIECES.split(", ")])
    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end: int = END, keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and its ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers (null without
    ``keep_ids``); ``length`` must be a power of two.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("the length of sequences must be a power of two")
    encoded = encode(docs, tokenizer_path, end)
    total = encoded.agg(F.sum("n")).first()[0] or 0
    found = encoded.select("doc_id", "ids", "n", "row").join(positions(encoded).hint("shuffle_hash"), "row")
    return found.select("doc_id", "ids", "n", "position").mapInArrow(
        _cut(length, sequence_bounds(total, length), keep_ids), _PIECES)


def unused_share(pieces: DataFrame, length: int = LENGTH) -> float:
    """The share of padding in the sequences of ``pieces``: those that are no power of two are padded to ``length``."""
    size = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    row = size.select("n", F.when(power, F.col("n")).otherwise(length).alias("room")).agg(
        F.sum("n").alias("n"), F.sum("room").alias("room")).first()
    return 0.0 if not row.room else 1 - row.n / row.room
