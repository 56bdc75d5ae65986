"""Operator 1: benchmark decontamination by n-gram seeds and local alignment.

1. The benchmark's word n-grams are the seeds. They are handed to the tasks in
   slices of a bounded number of items' words; each slice is two more passes.
2. A first pass counts the documents that hold each seed. Those in at most
   ``RARE_SHARE`` of all documents, or in at most ``RARE_DOCUMENTS``, are rare.
3. A second pass looks the seeds up in each whole text. Hits of one item at
   like offsets form a passage. One with a rare seed is aligned with its item
   (Smith-Waterman over words, linear gaps).
4. The rest, passages of frequent seeds alone, are aligned too, but for those
   whose shared words prove that no alignment can reach the score of a leak.
   So an item that thousands of documents hold is still found in each.
5. A passage leaks its item when the alignment scores at least ``MIN_SCORE``
   of what the item scores against itself, and ``MIN_POINTS`` or the whole
   item.

Both passes are narrow: one count per task and seed, and leaks, are shuffled,
so no key can grow hot.

Defined results: null or empty texts and items have no seeds and never match;
an item of fewer words than a seed has none either. Items with equal text are
matched each. A document that holds one item twice, and repeated rows with one
doc_id, give the best alignment of that (doc_id, item_id); ties go to the
earliest span. Null ids are kept as null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import grams, slices, stage, words_of

SEED_WORDS = 4
MIN_SCORE = 0.45
#: A shorter alignment (in score points, two a word) is no leak unless it is the whole item.
MIN_POINTS = 12
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of benchmark items that one broadcast holds (about 40 bytes each).
SLICE_WORDS = 1_000_000
#: A seed is rare up to this share of the documents, and up to this number of them in small tables.
RARE_SHARE, RARE_DOCUMENTS = 1e-3, 10


@dataclass
class Seeds:
    """A slice of the benchmark: items' word hashes and their n-grams, sorted by hash."""

    items: list
    words: list[np.ndarray]
    hash: np.ndarray
    item: np.ndarray
    at: np.ndarray
    rare: np.ndarray


def seeds_of(items: list, texts: list) -> Seeds:
    words, hashes, item, at = [], [], [], []
    for k, text in enumerate(texts):
        w = words_of(pa.array([text], pa.string()))
        h, first = grams(w.hash, w.doc, SEED_WORDS)
        words.append(w.hash)
        hashes.append(h)
        item.append(np.full(len(h), k))
        at.append(first)
    h = np.concatenate([*hashes, np.empty(0, np.uint64)])
    order = np.argsort(h, kind="stable")
    pick = lambda parts: np.concatenate([*parts, np.empty(0, np.int64)])[order].astype(np.int64)
    return Seeds(items, words, h[order], pick(item), pick(at), np.ones(len(h), bool))


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(best local score, end in ``b``) of two word sequences; ties: the earliest end."""
    best, end = 0, 0
    row = np.zeros(len(b) + 1, np.int64)
    ramp = -GAP * np.arange(len(b) + 1)
    for x in a:
        step = np.maximum(row[:-1] + np.where(b == x, MATCH, MISMATCH), row[1:] + GAP)
        row = np.concatenate([[0], np.maximum(step, 0)])
        row = np.maximum.accumulate(row + ramp) - ramp
        top = int(row.max())
        if top > best:
            best, end = top, int(row.argmax())
    return best, end


def best_span(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """(score as a share of the item's own, first word, end word) of the best alignment."""
    score, end = align(item, text)
    if not score:
        return 0.0, 0, 0
    back, length = align(item[::-1], text[:end][::-1])
    return score / (MATCH * len(item)), end - length, end


def score_bound(a: np.ndarray, b: np.ndarray) -> int:
    """At least the best local score: a word in the aligned part of ``a`` matches one of ``b`` or costs a mismatch or gap."""
    total = np.cumsum(np.where(np.isin(a, b), MATCH, max(MISMATCH, GAP)))
    return int(np.max(total - np.minimum.accumulate(np.r_[0, total[:-1]]), initial=0))


def hits_of(words, seeds: Seeds) -> tuple[np.ndarray, np.ndarray]:
    """(first word in the texts, index into the seeds) of every seed occurrence."""
    h, first = grams(words.hash, words.doc, SEED_WORDS)
    low = np.searchsorted(seeds.hash, h, side="left")
    found = np.zeros(len(h), bool)
    inside = low < len(seeds.hash)
    found[inside] = seeds.hash[low[inside]] == h[inside]
    low, first = low[found], first[found]
    n = np.searchsorted(seeds.hash, seeds.hash[low], side="right") - low
    begin = np.cumsum(n) - n
    return np.repeat(first, n), np.repeat(low - begin, n) + np.arange(n.sum())


def _count_seeds(seeds: Seeds):
    """Per task, the number of rows that hold each seed (by its hash), and of all rows under a null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, rows = np.unique(seeds.hash), 0
        counts = np.zeros(len(distinct), np.int64)
        for batch in batches:
            rows += batch.num_rows
            for _, texts in slices(batch.column(0)):
                words = words_of(texts)
                h, first = grams(words.hash, words.doc, SEED_WORDS)
                known = np.isin(h, distinct)
                at = np.searchsorted(distinct, h[known])
                held = np.unique(words.doc[first[known]].astype(np.int64) * max(len(distinct), 1) + at)
                counts += np.bincount(held % max(len(distinct), 1), minlength=len(distinct))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *distinct[found].view(np.int64).tolist()], pa.int64()),
             pa.array([rows, *counts[found].tolist()], pa.int64())], names=["seed", "n"])
    return run


def with_rare(seeds: Seeds, docs: DataFrame) -> Seeds:
    """``seeds`` with those marked rare that few of ``docs`` hold; at most one row per seed of the slice is fetched."""
    counts = docs.select(F.col("text").cast("string").alias("text")) \
        .mapInArrow(_count_seeds(seeds), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    rows = stage(counts.filter(F.col("seed").isNull() | (F.col("n") > RARE_DOCUMENTS)), "seed_counts")
    total = rows.filter("seed is null").first()
    most = max(RARE_DOCUMENTS, RARE_SHARE * (total.n if total else 0))
    frequent = [r.seed for r in rows.filter(F.col("seed").isNotNull() & (F.col("n") > most)).select("seed").collect()]
    return replace(seeds, rare=~np.isin(seeds.hash, np.array(frequent, np.int64).view(np.uint64)))


def leaks_of(words, seeds: Seeds, min_score: float = MIN_SCORE) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, first word of the row's span, end word) of the passages that leak."""
    first, seed = hits_of(words, seeds)
    if not len(first):
        return
    item, doc = seeds.item[seed], words.doc[first]
    offset = first - seeds.at[seed]
    order = np.lexsort((offset, item, doc))
    first, seed, item, doc, offset = (x[order] for x in (first, seed, item, doc, offset))
    rare = np.r_[0, np.cumsum(seeds.rare[seed])]
    size = np.array([len(w) for w in seeds.words])[item]
    new = np.ones(len(first), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (np.diff(offset) > np.maximum(size[1:] // 2, 2))
    starts = np.flatnonzero(new)
    begins = np.searchsorted(words.doc, np.arange(words.rows + 1))
    for a, b in zip(starts, np.r_[starts[1:], len(first)], strict=True):
        k, d, n = item[a], doc[a], size[a]
        low = max(begins[d], offset[a] - n // 2)
        high = min(begins[d + 1], offset[b - 1] + n + n // 2 + 1)
        least = max(min_score, min(1.0, MIN_POINTS / (MATCH * n)))
        own, text = seeds.words[k], words.hash[low:high]
        if rare[a] == rare[b] and min(score_bound(own, text), score_bound(text, own)) / (MATCH * n) < least:
            continue
        score, s, e = best_span(own, text)
        if score >= least:
            yield int(d), int(k), score, int(low + s), int(low + e)


def benchmark_slices(benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> Iterator[Seeds]:
    """The benchmark in slices of about ``slice_words`` words."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // (6 * slice_words)))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) \
            .orderBy("item_id", "text").collect()
        yield seeds_of([r.item_id for r in part], [r.text for r in part])


def _leaks(seeds: Seeds, min_score: float):
    def run(batches):
        for batch in batches:
            out = []
            ids = batch.column(0)
            for start, texts in slices(batch.column(1)):
                words = words_of(texts)
                begins = np.searchsorted(words.doc, np.arange(words.rows))
                for d, k, score, a, b in leaks_of(words, seeds, min_score):
                    low = int(words.text_start[d])
                    text = words.data[low:int(words.end[b - 1])]
                    chars = np.cumsum((text & 0xC0) != 0x80)
                    first = int(chars[words.start[a] - low]) - 1
                    out.append((ids[start + d].as_py(), seeds.items[k], score, a - int(begins[d]), b - int(begins[d]),
                                first, int(chars[-1])))
            names = ["doc_id", "item_id", "score", "first_word", "end_word", "first_char", "end_char"]
            kinds = [pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 7, kinds, strict=True)], names=names)
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, item_id, score, first_word, end_word, first_char, end_char``: the best leak of each pair.

    The span is the aligned part: words of the text counted from 0 to an
    exclusive end, and characters of the lower-case text likewise.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for seeds in benchmark_slices(benchmark):
        part = source.mapInArrow(_leaks(with_rare(seeds, source), min_score), (
            "doc_id long, item_id long, score double, first_word long, end_word long, first_char long, end_char long"))
        found = part if found is None else found.union(part)
    best = F.max(F.struct("score", *[(-F.col(c)).alias(c) for c in (
        "first_word", "end_word", "first_char", "end_char")])).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.score", *[(-F.col(f"b.{c}")).alias(c) for c in (
            "first_word", "end_word", "first_char", "end_char")])


def _clean(seeds: Seeds, column: int, min_score: float):
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for start, texts in slices(batch.column(column)):
                for d, *_ in leaks_of(words_of(texts), seeds, min_score):
                    keep[start + d] = False
            yield batch.filter(pa.array(keep))
    return run


def drop_leaking(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose text leaks no benchmark item."""
    column = docs.columns.index("text")
    kept = docs
    for seeds in benchmark_slices(benchmark):
        kept = kept.mapInArrow(_clean(with_rare(seeds, docs), column, min_score), docs.schema)
    return kept
