"""Operator 5: language proportions of each text by a mixture of n-gram models.

1. Each language's letter trigrams are counted (in ``BUCKETS`` hash buckets)
   over a sample of at most about ``MAX_ROWS`` labelled texts per language,
   chosen by a hash of the id; whole texts are read.
2. A text is a mixture of the languages: expectation-maximisation estimates
   the proportions that make its trigrams likeliest. All languages take part.
3. The languages are added in order of their proportions while the likelihood,
   less ``PENALTY`` per added language and log of the text's length, grows.
   The prediction is the largest of the chosen set; the score its proportion.

All texts of a few megabytes are estimated together in numpy; no shuffle but
of the counts.

Defined results: a null text or one without a letter is ``und`` with score 0.
With no labelled rows every text is ``und``. Ties go to the first language in
alphabetical order. Null languages are not learned from; repeated rows count
as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import slices, stage

BUCKETS = 1 << 15
MAX_ROWS = 3_000
ITERATIONS = 10
PENALTY = 6.0
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    p: np.ndarray  # BUCKETS x languages


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the trigrams of lower-case letters and gaps of each text, by row."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    low = pc.if_else(pc.match_substring_regex(low, r"\p{L}"), low, "")  # marks alone are no letters
    clean = pc.replace_substring_regex(low, r"[^\p{L}\p{M}]+", " ").to_pylist()
    points = np.frombuffer("\0".join([f" {t.strip()} " if t.strip() else "" for t in clean]).encode("utf-32-le"), np.uint32)
    if len(points) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    row = np.cumsum(points == 0)
    a, b, c = points[:-2].astype(np.uint64), points[1:-1].astype(np.uint64), points[2:].astype(np.uint64)
    whole = (a != 0) & (b != 0) & (c != 0)
    h = (a[whole] * np.uint64(0x9E3779B97F4A7C15) + b[whole]) * np.uint64(0xC2B2AE3D27D4EB4F) + c[whole]
    h = (h * np.uint64(0x165667B19E3779F9)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    key, count = np.unique(row[:-2][whole] * BUCKETS + h.astype(np.int64), return_counts=True)
    return key // BUCKETS, key % BUCKETS, count.astype(float)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for start, texts in slices(batch.column(0)):
            row, bucket, count = trigrams(texts)
            for lang in set(langs[start:start + len(texts)]):
                mine = np.array([x == lang for x in langs[start:start + len(texts)]])[row]
                total = totals.setdefault(lang, np.zeros(BUCKETS))
                total += np.bincount(bucket[mine], weights=count[mine], minlength=BUCKETS)
    for lang, total in totals.items():
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit, pa.int64()),
                                          pa.array(total[hit].astype(np.int64))], names=["lang", "bucket", "n"])


def fit(docs: DataFrame, training, max_rows: int = MAX_ROWS) -> Model:
    """Learn from the rows with text and lang for which ``training(id column)`` holds."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).filter(training("doc_id"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, max_rows / counts[lang]))])
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < share[F.col("lang")] * 1e6)
    got = chosen.select(F.col("text").cast("string"), F.col("lang").cast("string")) \
        .mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = stage(got, "trigrams").toArrow()  # at most BUCKETS rows for each language
    n = np.zeros((BUCKETS, len(languages)))
    at = {lang: k for k, lang in enumerate(languages)}
    n[table["bucket"].to_numpy(), [at[x] for x in table["lang"].to_pylist()]] = table["n"].to_numpy()
    return Model(languages, (n + 0.5) / (n.sum(axis=0) + 0.5 * BUCKETS))


def mixtures(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows with trigrams, proportions of the chosen languages in each)."""
    begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    group = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(row)]))
    like = p[bucket]
    totals = np.add.reduceat(count, begin)
    single = np.add.reduceat(count[:, None] * np.log(like), begin)
    k = p.shape[1]

    def improve(pi, times):
        for _ in range(times):
            w = pi[group] * like
            w *= (count / w.sum(axis=1))[:, None]
            pi = np.add.reduceat(w, begin) / totals[:, None]
        return pi

    pi = improve(np.full((len(begin), k), 1 / k), ITERATIONS)
    order = np.argsort(-pi, axis=1, kind="stable")
    best = np.zeros_like(pi)
    first = np.argmax(single, axis=1)
    best[np.arange(len(best)), first] = 1.0
    value = single[np.arange(len(best)), first]
    cost = PENALTY * np.log(totals + 1)
    for size in range(2, k + 1):
        # a set can only be better if its unpenalised likelihood, at most that of all languages, allows it
        inside = np.zeros_like(pi)
        np.put_along_axis(inside, order[:, :size], 1.0, axis=1)
        part = pi * inside
        part /= part.sum(axis=1, keepdims=True)
        part = improve(part, 2)
        got = np.add.reduceat(count * np.log((part[group] * like).sum(axis=1)), begin) - (size - 1) * cost
        better = got > value
        best[better], value[better] = part[better], got[better]
    return row[begin], best


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for start, texts in slices(batch.column(1), 6_000_000 // max(len(model.languages), 6)):
                n, k = len(texts), len(model.languages)
                share = np.zeros((n, k + 1))
                share[:, k] = 1.0
                if k:
                    row, bucket, count = trigrams(texts)
                    if len(row):
                        at, found = mixtures(row, bucket, count, model.p)
                        share[at, :k], share[at, k] = found, 0.0
                top = np.argmax(share, axis=1)
                score = np.where(top == k, 0.0, share[np.arange(n), top])
                held = [[(names[j], float(s[j])) for j in np.argsort(-s[:k], kind="stable") if s[j] >= 0.01] for s in share]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, n), pa.array(names[top], pa.string()),
                    pa.array(np.clip(score, 0.0, 1.0)),
                    pa.array([[x for x, _ in h] for h in held], pa.list_(pa.string())),
                    pa.array([[x for _, x in h] for h in held], pa.list_(pa.float64())),
                ], names=["doc_id", "lang_pred", "score", "languages", "shares"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, languages, shares`` of every text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_predict(model), "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>")
