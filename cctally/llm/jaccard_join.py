"""Operator 3: near-duplicate join on word shingles with Bayesian pruning.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles is at least 0.8.

1. Texts with equal shingle sets form one class; everything after works on
   classes, so a third of all rows being copies costs one row.
2. Each class has a MinHash signature. Classes that share a band of it are
   joined to the least class of that band; the components of these edges are
   the candidate groups.
3. A group is cut into blocks of bounded bytes, and every pair of blocks is a
   unit of work: no pair row is ever written. In a unit, MinHash values are
   compared sixteen at a time; a pair is dropped when the posterior
   probability that its similarity reaches the threshold falls below the
   tolerance (uniform prior). The rest are verified on their whole sets.
4. Units return, per class, its links weighted by the partners' copies, and a
   spanning forest of the verified links, from which the classes of linked
   texts are built.

Banding may miss a pair: with 30 bands of 5 rows a pair at similarity 0.8
exactly is missed with probability 7e-6, more similar pairs less often.

Defined results: a null text or one without words has no shingles, no links
and a class of its own row's id. A text of one to four words has one shingle.
Repeated rows are copies and link to each other. A null doc_id is kept; it is
a class's id only if no row of that class has an id. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cctally.llm.common import U64, mix, shingles, slices, stage, words_of
from cctally.llm.components import components

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-4
BANDS, BAND_ROWS = 30, 5
STEP = 16
#: Bytes of shingle sets in a block of a candidate group.
BLOCK_BYTES = 4_000_000
#: Rows of candidate classes that may be broadcast (40 bytes each).
BROADCAST_ROWS = 200_000

_HASHES = BANDS * BAND_ROWS
_FACTORS = mix(np.arange(1, _HASHES + 1, dtype=U64)) | U64(1)


def set_keys(rows: int, doc: np.ndarray, h: np.ndarray) -> list[bytes | None]:
    """A 16-byte key of each row's shingle set (None: no shingles)."""
    a, b = np.zeros(rows, U64), np.zeros(rows, U64)
    np.add.at(a, doc, mix(h))
    np.add.at(b, doc, mix(h ^ U64(0xD6E8FEB86659FD93)))
    count = np.bincount(doc, minlength=rows)
    raw = np.stack([mix(a + count.astype(U64)), mix(b)], axis=1).astype(">u8").tobytes()
    return [raw[16 * i:16 * i + 16] if count[i] else None for i in range(rows)]


def signatures(rows: int, doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """MinHash values, a row for each text; rows without shingles hold zeros."""
    out = np.zeros((rows, _HASHES), np.uint32)
    if len(h):
        at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        for k in range(_HASHES):
            out[doc[at], k] = np.minimum.reduceat((h * _FACTORS[k]) >> U64(32), at)
    return out


def _bands(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(U64)
    total = np.zeros(parts.shape[:2], U64) + np.arange(BANDS, dtype=U64)
    for k in range(BAND_ROWS):
        total = mix(total * U64(0x100000001B3) + parts[:, :, k])
    return total.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in slices(batch.column(1)):
            doc, h = shingles(words_of(texts), WORDS)
            n = len(texts)
            bands = _bands(signatures(n, doc, h))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(start, n), pa.array(set_keys(n, doc, h), pa.binary()),
                pa.array(np.bincount(doc, minlength=n), pa.int64()),
                pa.ListArray.from_arrays(np.arange(0, BANDS * n + 1, BANDS, dtype=np.int32), bands.ravel()),
            ], names=["doc_id", "set_key", "n_shingles", "bands"])


def least_matches(threshold: float, tolerance: float, total: int, step: int) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones to go on): fewer leave a posterior below the tolerance.

    With a uniform prior, the similarity after m of n equal values is
    Beta(m+1, n-m+1); its upper tail at t is P(Binomial(n+1, t) <= m).
    """
    out = []
    for n in [*range(step, total, step), total]:
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def linked_pairs(sets: list[np.ndarray], signature: np.ndarray, left: np.ndarray, right: np.ndarray | None,
                 threshold: float, tolerance: float) -> Iterator[tuple[int, np.ndarray]]:
    """For rows of ``left``, their linked rows of ``right`` (later ones of ``left`` if None)."""
    rules = least_matches(threshold, tolerance, signature.shape[1], STEP)
    flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    mark = np.zeros(int(flat.max()) + 1 if len(flat) else 0, bool)
    for p, i in enumerate(left):
        others = left[p + 1:] if right is None else right
        small, big = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        others = others[small >= threshold * big]
        equal, done = np.zeros(len(others), np.int64), 0
        for n, least in rules:
            equal += (signature[others, done:n] == signature[i, done:n]).sum(axis=1)
            others, equal, done = others[equal >= least], equal[equal >= least], n
            if not len(others):
                break
        if not len(others):
            continue
        mark[sets[i]] = True
        lengths = sizes[others]
        begin = np.cumsum(lengths) - lengths
        at = np.repeat(ends[others] - lengths - begin, lengths) + np.arange(lengths.sum())
        both = np.add.reduceat(mark[flat[at]], begin, dtype=np.int64)
        mark[sets[i]] = False
        good = others[both >= threshold * (sizes[i] + lengths - both) - 1e-9]
        if len(good):
            yield i, good


def _unit(threshold: float, tolerance: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        _, first, second = key
        texts = pa.array(pdf["text"], pa.string())
        sets, values, keys = [], [], []
        for _, part in slices(texts):
            doc, h = shingles(words_of(part), WORDS)
            keys += set_keys(len(part), doc, h)
            values.append(signatures(len(part), doc, h))
            sets += np.split(h, np.searchsorted(doc, np.arange(1, len(part))))
        want, seen, rows = pdf["set_key"].tolist(), set(), []
        for r, k in enumerate(keys):  # rows of another text with the same id, and copies, go
            if k is not None and k == bytes(want[r]) and k not in seen:
                seen.add(k)
                rows.append(r)
        rows = np.array(rows, np.int64)
        _, flat = np.unique(np.concatenate([sets[r] for r in rows] or [np.empty(0, U64)]), return_inverse=True)
        cut = np.cumsum([len(sets[r]) for r in rows])[:-1]
        local = [np.asarray(x, np.int64) for x in np.split(flat, cut)] if len(rows) else []
        signature = np.concatenate(values)[rows]
        block = pdf["block"].to_numpy()[rows]
        copies = pdf["copies"].to_numpy()[rows]
        links, parent = np.zeros(len(rows), np.int64), np.arange(len(rows))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        left = np.flatnonzero(block == first)
        right = None if first == second else np.flatnonzero(block == second)
        for i, found in linked_pairs(local, signature, left, right, threshold, tolerance):
            links[i] += copies[found].sum()
            links[found] += copies[i]
            for j in found[parent[found] != parent[i]]:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        hit = np.flatnonzero(links)
        return pd.DataFrame({"u": [keys[rows[i]] for i in hit], "v": [keys[rows[root(i)]] for i in hit],
                             "links": links[hit]})
    return run


def _keyed(column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(column)):
                doc, h = shingles(words_of(texts), WORDS)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(set_keys(len(texts), doc, h), pa.binary())],
                    names=[*batch.schema.names, "_set_key_"])
    return run


def _classes(docs: DataFrame, threshold: float, tolerance: float, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(sketch of every row, facts of every shingle set: ``set_key, root, class_id, n_links``)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stage(source.mapInArrow(
        _sketch, "doc_id long, set_key binary, n_shingles long, bands array<long>"), "sketch")
    whole = sketch.filter("set_key is not null")
    classes = stage(whole.groupBy("set_key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"),
                                                 F.max("n_shingles").alias("n_shingles")), "classes")
    banded = whole.select("set_key", F.explode("bands").alias("band")).distinct()
    shared = banded.groupBy("band").agg(F.min("set_key").alias("v"), F.max("set_key").alias("last")) \
        .filter("v <> last").select("band", "v")
    groups = components(banded.join(shared, "band").select(F.col("set_key").alias("u"), "v"))

    members = groups.join(classes, F.col("node") == F.col("set_key")) \
        .select("set_key", "root", "copies", "doc_id", (F.col("n_shingles") * 8 + 2000).alias("weight"))
    blocks = members.groupBy("root").agg(F.ceil(F.sum("weight") / block_bytes).cast("int").alias("n_blocks"))
    members = stage(members.join(blocks, "root").withColumn(
        "block", F.pmod(F.xxhash64("set_key"), F.col("n_blocks")).cast("int")), "members")
    if members.count() <= BROADCAST_ROWS:
        members = F.broadcast(members)
    texts = source.withColumnRenamed("doc_id", "id").join(
        members, F.col("id").eqNullSafe(F.col("doc_id"))).select("set_key", "root", "copies", "block", "n_blocks", "text")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    units = texts.withColumn("other", other).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "set_key", "copies", "block", "text")
    linked = stage(units.groupBy("root", "i", "j").applyInPandas(
        _unit(threshold, tolerance), "u binary, v binary, links long"), "links")

    roots = components(linked.select("u", "v"))
    labels = roots.join(classes.select("set_key", "doc_id"), F.col("node") == F.col("set_key"))
    least = labels.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    counts = linked.groupBy(F.col("u").alias("set_key")).agg(F.sum("links").alias("links"))
    found = labels.join(least, "root").select("set_key", "root", "class_id").join(counts, "set_key", "left")
    return sketch, stage(classes.join(found, "set_key", "left").select(
        "set_key", F.coalesce("root", "set_key").alias("root"), F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "facts")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links``.

    ``class_id`` is the least doc_id of the texts reachable by links;
    ``n_links`` counts the other rows at or above the threshold.
    """
    sketch, facts = _classes(docs, threshold, tolerance, block_bytes)
    return sketch.select("doc_id", "set_key").join(facts, "set_key", "left").select(
        "doc_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns kept, with one row of each class of linked texts.

    That row has the least doc_id of its class; of several such rows the one
    with the least hash of its columns. Texts without words all stay.
    """
    sketch, facts = _classes(docs, threshold, tolerance, block_bytes)
    linked = facts.filter("n_links > 0").select(F.col("set_key").alias("_key"), "root", "class_id")
    winner = F.col("doc_id").eqNullSafe(F.col("class_id"))
    firsts = stage(sketch.select("doc_id", "set_key").join(linked, F.col("set_key") == F.col("_key")).filter(winner)
                   .groupBy("root").count().filter("count > 1").select(F.col("root").alias("several")), "several")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kinds = StructType([*docs.schema.fields, StructField("_set_key_", BinaryType())])
    keyed = docs.mapInArrow(_keyed(docs.columns.index("text")), kinds) \
        .select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "_set_key_") \
        .join(linked, F.col("_set_key_") == F.col("_key"), "left") \
        .join(firsts, F.col("root") == F.col("several"), "left")
    out = keyed.filter(F.col("_key").isNull() | (winner & F.col("several").isNull())).select("row.*")
    if not firsts.isEmpty():
        again = keyed.filter(winner & F.col("several").isNotNull()).withColumn("h", F.xxhash64("row"))
        out = out.union(again.groupBy("root").agg(F.min_by("row", "h").alias("row")).select("row.*"))
    return out
