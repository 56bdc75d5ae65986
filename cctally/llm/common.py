"""Shared helpers: staged tables, row helpers, hashed word shingles.

The shingle helpers work on one Arrow string array at a time, in slices of a
few megabytes, so a task's memory does not depend on its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cctally.session import freed_shuffles, staging_dir

#: Bytes of text that one vectorised step handles.
SLICE_BYTES = 2_000_000

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor re-reads files instead
    of computing the steps before them again. Shuffle files of ``df`` go when
    it is written.
    """
    path = staging_dir(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(column, folds: int, fold: int):
    """True when crc32 of the id as text leaves ``fold``; a null id is in training."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) pairs of at most ``limit`` bytes each, or one row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, column.slice(start, stop - start)
        start = stop


def powers(n: int, base: int, cache: dict = {}) -> np.ndarray:  # noqa: B006  (a cache)
    """base**0 .. base**(n-1) modulo 2**64."""
    have = cache.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        cache[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64: spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span that depends on nothing else."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(len(data), _BASE), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(len(data) + 1, _INVERSE)[start])


_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Words:
    """The words of a slice of texts, in order; ``doc`` is the row of each."""

    rows: int
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text_start: np.ndarray
    data: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """Lower-case words (runs of letters and digits; every non-ASCII character counts as a letter)."""
    low = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    n = len(low)
    _, offsets, data = low.buffers()
    offsets = np.frombuffer(offsets, np.int64)[low.offset:low.offset + n + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _WORD_BYTE[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    ends = inside[:-1] & ~inside[1:]
    ends[edges[edges > 0] - 1] |= inside[edges[edges > 0] - 1]
    end = np.flatnonzero(ends) + 1
    h = span_hashes(data, start, end)
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(n, doc, start, end, h, offsets, data)


def grams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``n`` words within one text."""
    if len(hashes) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    first = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1:])
    total = np.zeros(len(first), U64)
    for k in range(n):
        total = mix(total * U64(0x100000001B3) + hashes[first + k])
    return total, first


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash), distinct and sorted, of the ``n``-word shingles of each text.

    A text of fewer than ``n`` words, but at least one, has one shingle: all
    its words.
    """
    h, first = grams(words.hash, words.doc, n)
    doc = words.doc[first]
    count = np.bincount(words.doc, minlength=words.rows)
    for k in range(1, n):
        short = np.flatnonzero(count == k)
        if len(short):
            at = np.searchsorted(words.doc, short)
            total = np.full(len(short), k, U64)
            for j in range(k):
                total = mix(total * U64(0x100000001B3) + words.hash[at + j])
            h, doc = np.concatenate([h, total]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[keep], h[keep]
