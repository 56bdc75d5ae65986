"""Operator 8: exact top-k search over binary codes by incremental multi-index hashing.

Vectors become codes of one sign bit per dimension. Equal codes are one entry
of the index with the least ids of its rows, so a vector that a third of all
rows share is one entry. Every code is listed under each of its ``m`` segments
(about log2 of the number of codes, less 2, bits wide).

A query probes, in round r, the segment values at distance r from its own.
After round r every code within distance ``m * (r + 1) - 1`` has been met: a
farther-off code differs by more than r in each segment. A query is done when
its k-th verified distance is within that bound; the others go on. A round is
an equi-join on (segment, value) whose condition keeps only codes that can
still enter a query's result; the driver sees the number of open queries.

Results are ordered by (distance, id), so ties at the last place go to the
least ids. A query's own row is not its neighbour.

Defined results: rows with a null id or a null or empty vector are neither
indexed nor queried; a null component counts as not positive; shorter vectors
are padded with zero bits to the longest. With fewer than k other rows all are returned.
Rows that repeat an id count once per code. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cctally.llm.common import stage

K = 10
WORD = 64


def binary_codes(vectors: DataFrame, id_column: str, vector_column: str, words: int) -> DataFrame:
    """``id`` and ``code``, an array of ``words`` 64-bit integers: the signs of each vector."""
    v = F.col(vector_column)
    sign = lambda i: F.when(F.coalesce(F.get(v, i), F.lit(0.0)) > 0, "1").otherwise("0")
    word = lambda k: F.conv(F.array_join(F.transform(
        F.sequence(F.lit(WORD * k), F.lit(WORD * k + WORD - 1)), sign), ""), 2, -10).cast("long")
    return vectors.filter(F.col(id_column).isNotNull() & (F.size(v) > 0)).select(
        F.col(id_column).cast("long").alias("id"), F.array(*[word(k) for k in range(words)]).alias("code"))


def words_needed(vectors: DataFrame, vector_column: str) -> int:
    """64-bit integers that hold a sign of every component of the longest vector."""
    return max(1, -(-(vectors.agg(F.max(F.size(vector_column))).first()[0] or 0) // WORD))


def segment_spans(words: int, codes: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of the segments: near log2(codes) - 2 bits, of 4 to 32, widths alike.

    A probe then meets about four codes: to verify those is cheaper than the
    probes of wider segments, whose number grows much faster with the radius.
    """
    parts = max(2, min(16, round(WORD / max(1.0, log2(max(codes, 2)) - 2))))
    edges = [WORD * k // parts for k in range(parts + 1)]
    return [(w, a, b - a) for w in range(words) for a, b in zip(edges, edges[1:], strict=False)]


def _values(spans: list[tuple[int, int, int]], radius: int | None) -> Column:
    """Array of (segment, value): the code's own, or those at ``radius`` flips from it."""
    def probes(k: int, word: int, shift: int, width: int) -> Column:
        own = F.shiftrightunsigned(F.get(F.col("code"), F.lit(word)), shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        flips = ",".join(str(sum(1 << b for b in c)) for c in combinations(range(width), radius or 0))
        masks = F.split(F.lit(flips), ",").cast("array<bigint>")  # folded into one literal
        return F.transform(masks, lambda x: F.struct(F.lit(k).alias("segment"), own.bitwiseXOR(x).alias("value")))

    return F.concat(*[probes(k, *span) for k, span in enumerate(spans) if (radius or 0) <= span[2]])


def _distance(a: str, b: str, words: int) -> Column:
    total = F.lit(0)
    for k in range(words):
        total = total + F.bit_count(F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k))))
    return total


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, words: int = 1) -> DataFrame:
    """``query_id, rank, neighbour_id, distance``: the ``k`` rows of ``codes`` nearest to each query.

    Both have ``id`` and ``code`` (an array of ``words`` 64-bit integers).
    """
    by_id = Window.partitionBy("code").orderBy("id")
    index = stage(codes.distinct().withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
                  .groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "index")
    facts = index.agg(F.count("*").alias("codes"), F.sum(F.size("ids")).alias("rows")).first()
    spans = segment_spans(words, facts.codes)
    listed = index.select(F.col("code").alias("found"), "ids", F.inline(_values(spans, None)))
    asked = stage(queries.distinct(), "asked")
    pending = stage(asked.select("code").distinct().withColumn("limit", F.lit(WORD * words)), "pending")
    held, done, radius = None, [], 0
    wanted = min(k + 1, facts.rows or 0)
    nearest = Window.partitionBy("code").orderBy("distance", "id")
    while True:
        probes = pending.select("code", "limit", F.inline(_values(spans, radius)))
        # the probes are many more than their estimate: without the hint Spark would broadcast them
        met = probes.join(listed.hint("shuffle_hash"), (probes.segment == listed.segment) & (probes.value == listed.value)
                          & (_distance("code", "found", words) <= F.col("limit"))) \
            .select("code", "found", "ids").distinct() \
            .select("code", _distance("code", "found", words).cast("int").alias("distance"), F.explode("ids").alias("id"))
        if held is not None:
            met = met.union(held.join(pending, "code", "left_semi").select("code", "distance", "id")).distinct()
        held = stage(met.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k + 1), "nearest")
        bound = len(spans) * (radius + 1) - 1
        if radius >= max(w for _, _, w in spans):
            bound = WORD * words
        last = held.groupBy("code").agg(F.max("place").alias("places"), F.max("distance").alias("far"))
        complete = (F.col("places") >= wanted) & (F.col("far") <= bound) if bound < WORD * words else F.lit(True)
        done.append(held.join(last.filter(complete).select("code"), "code", "left_semi"))
        if bound >= WORD * words:
            break
        after = pending.select("code").join(last, "code", "left").filter(~F.coalesce(complete, F.lit(False)))
        pending = stage(after.select("code", F.when(F.col("places") >= k + 1, F.col("far"))
                                     .otherwise(F.lit(WORD * words)).alias("limit")), "pending")
        if pending.isEmpty():
            break
        radius += 1
    found = done[0]
    for part in done[1:]:
        found = found.union(part)
    rank = F.row_number().over(Window.partitionBy("query_id", "code").orderBy("distance", "id"))
    return asked.select(F.col("id").alias("query_id"), "code").join(found, "code") \
        .filter("query_id <> id").withColumn("rank", rank).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("neighbour_id"), "distance")


ORACLE_SQL = f"""
WITH bits AS (SELECT vec_id, list_transform(range(1, {WORD + 1}), lambda i: coalesce(embedding[i] > 0, false)) AS b
              FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
pairs AS (SELECT q.vec_id AS query_id, n.vec_id AS neighbour_id,
    CAST(list_sum(list_transform(range(1, {WORD + 1}), lambda i: CAST(q.b[i] <> n.b[i] AS INTEGER))) AS INTEGER) AS distance
    FROM bits q, bits n WHERE q.vec_id % 50 = 0 AND q.vec_id <> n.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= {K}
"""
