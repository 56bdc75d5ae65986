"""Operator 7: toxicity scores from boosted trees over dense features, calibrated.

1. At most about ``MAX_TRAIN`` labelled rows (chosen by a hash of the id) are
   the training sample; only their ids are broadcast.
2. The lexicon is learned from them: word stems (whole words and prefixes of
   four to eight letters) that are far more common in toxic texts, in a strong
   and a weak list. A stem needs ``MIN_SUPPORT_SHARE`` of the sample's toxic
   texts, and ``MIN_SUPPORT`` of them; every one that has it is listed.
3. Every whole text gets dense features in one narrow Arrow pass: lexicon
   densities, lexicon hits near a second person, capitals, punctuation,
   obfuscation and elongation rates, length.
4. ``GBTClassifier`` is fitted on three quarters of the sample,
   ``IsotonicRegression`` calibrates its margin on the last quarter, and both
   score all texts in the JVM.

A text is never cut. Scores depend on the text alone.

Defined results: a null or empty text is scored from features that are all
zero. Labels with a null id or value are ignored; of repeated labels the
largest counts. With no labelled rows every score is 0; with labels of one
class only, that class's value. Repeated rows are scored each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from cctally.llm.bpe import split_words
from cctally.llm.common import slices, stage

MAX_TRAIN = 16_000
STEM_LENGTHS = (4, 5, 6, 7, 8)
MIN_SUPPORT_SHARE, MIN_SUPPORT = 0.02, 3
STRONG_LIFT, WEAK_LIFT = 30.0, 6.0
NEAR_WORDS = 5
CALIBRATION_SHARE = 0.25
TREES, DEPTH, SEED = 20, 4, 7

SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie "
    "tu toi te ton ta tes vous votre vos ti tú usted ustedes vosotros").split()
FEATURES = (
    "strong_density", "weak_density", "strong_any", "strong_count", "strong_near_you", "you_density", "capitals",
    "capital_words", "punctuation", "marks", "digits", "obfuscated", "elongated", "strong_obfuscated", "log_words")


@dataclass
class Lexicon:
    strong: list[str] = field(default_factory=list)
    weak: list[str] = field(default_factory=list)


def _plain(tokens: pa.Array) -> pa.Array:
    """Lower-case tokens with look-alike signs between letters read as letters and other signs removed."""
    low = pc.utf8_lower(tokens)
    for sign, letter in (("0", "o"), ("1", "i"), ("3", "e"), ("4", "a"), ("@", "a"), (r"\$", "s")):
        low = pc.replace_substring_regex(low, rf"(\p{{L}}){sign}(\p{{L}})", rf"\1{letter}\2")
    return pc.replace_substring_regex(low, r"[^\p{L}\p{N}]+", "")


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets of the texts, index of each token, distinct tokens)."""
    split = split_words(texts)
    coded = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    return offsets, coded.indices.to_numpy(), coded.dictionary


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, in how many (document, distinct word) pairs of either class each stem occurs."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for start, texts in slices(batch.column(0)):
            offsets, at, distinct = _tokens(texts)
            plain = _plain(distinct).dictionary_encode()
            word = plain.indices.to_numpy()[at]
            doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
            pairs = np.unique(doc.astype(np.int64) * max(len(plain.dictionary), 1) + word)
            label = toxic[start + pairs // max(len(plain.dictionary), 1)]
            words = plain.dictionary.to_pylist()
            for kind in (0, 1):
                n = np.bincount(pairs[label == kind] % max(len(words), 1), minlength=len(words))
                for k in np.flatnonzero(n):
                    w, c = words[k], int(n[k])
                    if w:
                        counts[kind]["" ] += c
                        counts[kind][w + "$"] += c
                        for length in STEM_LENGTHS:
                            if len(w) >= length:
                                counts[kind][w[:length]] += c
    keys = [k for k in counts[1]]  # a stem that no toxic text has cannot enter the lexicon
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()),
         pa.array([counts[0][k] for k in keys], pa.int64())], names=["stem", "toxic", "clean"])
    missing = [k for k in counts[0] if k not in counts[1]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(missing, pa.string()), pa.array([0] * len(missing), pa.int64()),
         pa.array([counts[0][k] for k in missing], pa.int64())], names=["stem", "toxic", "clean"])


def learn_lexicon(train: DataFrame, positives: int) -> Lexicon:
    """The lexicon of a training sample ``(text, toxic)``.

    The least support bounds what reaches the driver: the lists together hold
    at most ``6 / MIN_SUPPORT_SHARE`` stems for each distinct word of a mean toxic text.
    """
    counts = train.select("text", "toxic").mapInArrow(_count_stems, "stem string, toxic long, clean long") \
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    support = max(MIN_SUPPORT, int(MIN_SUPPORT_SHARE * positives))
    kept = stage(counts.filter((F.col("toxic") >= support) | (F.col("stem") == "")), "stems")
    total = kept.filter("stem = ''").first()
    if total is None or not total.toxic:
        return Lexicon()
    lift = (F.col("toxic") / F.lit(total.toxic)) / ((F.col("clean") + 0.5) / F.lit(total.clean + 1))
    found = Lexicon()
    for low, high, out in ((STRONG_LIFT, None, found.strong), (WEAK_LIFT, STRONG_LIFT, found.weak)):
        chosen = kept.filter("stem <> ''").withColumn("lift", lift).filter(F.col("lift") >= low)
        if high:
            chosen = chosen.filter(F.col("lift") < high)
        have = {r.stem for r in chosen.select("stem").collect()}
        for stem in sorted(have):  # a stem of which a shorter prefix is listed adds nothing
            bare = stem.rstrip("$")
            if not any(bare[:n] in have for n in STEM_LENGTHS if n < len(bare) or (n == len(bare) and stem[-1] == "$")):
                out.append(stem)
    return found


def _listed(plain: pa.Array, stems: list[str]) -> np.ndarray:
    """Which words are, or begin with, one of ``stems`` (``$`` marks whole words)."""
    found = pc.is_in(plain, pa.array([s[:-1] for s in stems if s[-1] == "$"], pa.string())).to_numpy(zero_copy_only=False)
    for n in STEM_LENGTHS:
        prefixes = pa.array([s for s in stems if s[-1] != "$" and len(s) == n], pa.string())
        found = found | pc.is_in(pc.utf8_slice_codeunits(plain, 0, n), prefixes).to_numpy(zero_copy_only=False)
    return found


def features_of(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """The features of each text, a row each."""
    offsets, at, distinct = _tokens(texts)
    n = len(texts)
    words = np.diff(offsets)
    if not len(at):
        return np.zeros((n, len(FEATURES)))
    plain = _plain(distinct)
    match = lambda p, column=plain: pc.match_substring_regex(column, p).to_numpy(zero_copy_only=False)
    count = lambda p: pc.count_substring_regex(distinct, p).to_numpy(zero_copy_only=False).astype(float)
    raw = pc.utf8_lower(distinct)
    strong, weak = _listed(plain, lexicon.strong), _listed(plain, lexicon.weak)
    hidden = match(r"\p{L}[^\p{L}\s'’\-]+\p{L}", raw) | match(r"[#$%&*@]{2,}", raw)
    you = pc.is_in(plain, pa.array(SECOND_PERSON)).to_numpy(zero_copy_only=False)
    upper, letters = count(r"\p{Lu}"), count(r"\p{L}")
    facts = [strong, weak, you, upper, (upper >= 2) & (upper == letters), count(r"[\p{P}\p{S}]"), count(r"[!?]"),
             count(r"\p{Nd}"), hidden, match("a{3}|e{3}|i{3}|o{3}|u{3}|!{2}|\\?{2}", raw), strong & hidden, letters,
             pc.utf8_length(distinct).to_numpy(zero_copy_only=False)]
    s = np.empty((len(facts), n))
    for k, fact in enumerate(facts):  # the running sums of one fact at a time
        sums = np.r_[0.0, np.cumsum(fact.astype(float)[at])]
        s[k] = sums[offsets[1:]] - sums[offsets[:-1]]
    hits = np.flatnonzero(strong[at])
    doc = np.searchsorted(offsets, hits, side="right") - 1
    low = np.maximum(hits - NEAR_WORDS, offsets[doc])
    high = np.minimum(hits + NEAR_WORDS + 1, offsets[doc + 1])
    yours = np.r_[0, np.cumsum(you[at])]
    near = np.bincount(doc, weights=yours[high] > yours[low], minlength=n)
    w, chars, let = np.maximum(words, 1), np.maximum(s[12], 1), np.maximum(s[11], 1)
    return np.stack([s[0] / w, s[1] / w, s[0] > 0, np.log1p(s[0]), near / w, s[2] / w, s[3] / let, s[4] / w,
                     s[5] / chars, s[6] / w, s[7] / chars, s[8] / w, s[9] / w, s[10] / w, np.log1p(words)], axis=1)


def _featurise(lexicon: Lexicon, keep_text: bool = False):
    """The first column is the text; it goes on with the others if ``keep_text``."""
    kept = 0 if keep_text else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(0)):
                x = features_of(texts, lexicon)
                n = len(texts)
                lists = pa.ListArray.from_arrays(
                    np.arange(0, n * len(FEATURES) + 1, len(FEATURES), dtype=np.int32), x.ravel())
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(start, n) for c in batch.columns[kept:]], lists],
                    names=[*batch.schema.names[kept:], "features"])
    return run


@dataclass
class Model:
    lexicon: Lexicon
    trees: object | None
    calibration: object | None
    constant: float


def fit(docs: DataFrame, labels: DataFrame, training, max_train: int = MAX_TRAIN) -> Model:
    """Learn from the labelled rows for which ``training(id column)`` holds."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic")) \
        .filter(training("id"))
    n = known.count()
    share = F.lit(min(1.0, max_train / max(n, 1)) * 1e6)
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)  # at most about max_train rows of 12 bytes
    sample = stage(docs.select("doc_id", F.col("text").cast("string").alias("text"))
                   .join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
                   .select("text", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1000))
                                             < CALIBRATION_SHARE * 1000).alias("held")), "toxic_sample")
    classes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        return Model(Lexicon(), None, None, float(max(classes, default=0)))
    lexicon = learn_lexicon(sample.filter("not held"), classes[1])
    data = stage(sample.mapInArrow(_featurise(lexicon), "toxic int, held boolean, features array<double>"),
                 "toxic_features").select(F.col("toxic").cast("double").alias("label"), "held",
                                          array_to_vector("features").alias("x"))
    if data.filter("not held").select("label").distinct().count() < 2:
        return Model(lexicon, None, None, classes[1] / sum(classes.values()))
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED,
                          cacheNodeIds=False, checkpointInterval=-1).fit(
        data.filter("not held").coalesce(4))
    margins = trees.transform(data.filter("held")).select("label", vector_to_array("rawPrediction")[1].alias("m"))
    calibration = None
    if margins.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(featuresCol="m", labelCol="label", predictionCol="score").fit(margins)
    return Model(lexicon, trees, calibration, classes[1] / sum(classes.values()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` (which must not be named as the model's) plus ``score`` from 0 to 1."""
    if model.trees is None:
        return docs.withColumn("score", F.lit(model.constant))
    names = [c for c in docs.columns]
    plain = docs.schema["text"].dataType == StringType()
    if plain:  # a text that is a string goes to the task once
        first, sent = F.col("text"), ["text", *[c for c in names if c != "text"]]
    else:
        first, sent = F.col("text").cast("string").alias("_text_"), names
    kinds = StructType([*[docs.schema[c] for c in sent], StructField("features", ArrayType(DoubleType()))])
    found = docs.select(first, *[F.col(f"`{c}`") for c in sent[1 if plain else 0:]]).mapInArrow(
        _featurise(model.lexicon, keep_text=plain), kinds)
    row = found.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), array_to_vector("features").alias("x"))
    scored = model.trees.transform(row)
    if model.calibration is not None:
        scored = model.calibration.transform(scored.withColumn("m", vector_to_array("rawPrediction")[1]))
    else:
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.select("row.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))
