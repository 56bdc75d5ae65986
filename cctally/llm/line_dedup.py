"""Operator 2: removal of repeated multi-line chunks with content-defined boundaries.

Native: DataFrame functions only.

1. A 64-bit rolling hash over each line and the one before it is counted over
   the corpus, without texts. Lines belong together where it occurs more than
   once; a run ends where it occurs once.
2. Within a run a chunk starts where a second rolling hash, over hashes of the
   two lines, is less than those on either side. Boundaries depend on two
   lines to each side alone, so a shift of lines elsewhere moves none, and no
   chunk has less than two lines.
3. Chunks are grouped by their whole bytes; all but the first occurrence
   (least doc_id, then text digest, then line) are removed.

A run that stands whole in several texts is cut alike in each and goes whole.
Where one text holds a part of another's run, the chunks at the part's ends may
differ and stay. A collision of the 64-bit hash joins two lines too many and
can hide a repeat at that place; it never removes a line.

A passage in a third of all rows is one row per task in both groupings, and
its occurrences meet their first one in a join that adaptive execution splits.

Defined results: a null text stays null and an empty one empty. A text whose
chunks are all removed is empty. Rows equal in doc_id and text are one
occurrence and get the same result. A null doc_id sorts first. Lines end at
``\\n`` only; other columns pass through unchanged, but for those named like
the two counts, which the counts replace.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import stage

FACTOR = 31


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _pairs(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, at, h`` of each line that has one before it; ``h`` covers both."""
    # the digest goes through the generator, which would else have it computed for each line anew
    pair = let(F.md5("text"), lambda digest: let(_lines(F.col("text")), lambda v: F.transform(
        F.slice(v, 2, F.size(v)), lambda line, i: F.struct(
            digest.alias("digest"), (i + 1).alias("at"), F.xxhash64(F.get(v, i), line).alias("h")))))
    return docs.filter("text is not null").select("doc_id", F.inline(pair))


def chunk_spans(lines: Column, joined: Column) -> Column:
    """Array of (start line, number of lines) of the chunks of an array of lines.

    ``joined``: ascending numbers of the lines that belong with the line before.
    """
    def spans(v: Column, m: Column) -> Column:
        roll = lambda i: F.get(v, i) + FACTOR * F.get(v, i - 1)
        before = lambda k: (k > 0) & (F.get(m, k - 1) == F.get(m, k) - 1)
        after = lambda k: (k + 1 < F.size(m)) & (F.get(m, k + 1) == F.get(m, k) + 1)
        least = lambda i: (roll(i) < roll(i - 1)) & (roll(i) < roll(i + 1))
        starts = F.filter(F.transform(m, lambda at, k: F.struct(
            k.alias("k"), F.when(~before(k), at - 1).when(after(k) & least(at), at).alias("at"), before(k).alias("inside"))),
            lambda s: s["at"].isNotNull())
        return let(starts, lambda s: F.transform(s, lambda a, j: F.struct(
            a["at"].alias("at"),
            (F.coalesce(F.get(s, j + 1)["k"], F.size(m)) - a["k"] + F.when(a["inside"], 0).otherwise(1)).alias("n"))))
    return let(F.transform(lines, _hash), lambda v: let(joined, lambda m: spans(v, m)))


def _chunks(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``doc_id, digest, at, n, chunk`` of the chunks of all runs."""
    joined = _pairs(docs).join(repeated, "h", "left_semi") \
        .groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")) \
        .agg(F.sort_array(F.collect_set("at")).alias("_joined"))
    cut = let(_lines(F.col("text")), lambda lines: F.transform(
        chunk_spans(lines, F.col("_joined")),
        lambda c: F.struct(c["at"].alias("at"), c["n"].alias("n"),
                           F.array_join(F.slice(lines, c["at"] + 1, c["n"]), "\n").alias("chunk"))))
    return docs.join(joined, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.md5("text") == F.col("_digest"))) \
        .select("doc_id", F.col("_digest").alias("digest"), F.inline(cut))


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` but for the ascending, disjoint spans ``gone``."""
    def rest(g: Column) -> Column:
        end = lambda k: F.coalesce(F.get(g, k - 1)["at"] + F.get(g, k - 1)["n"], F.lit(0))
        kept = F.transform(F.sequence(F.lit(0), F.size(g)), lambda k: F.slice(
            lines, end(k) + 1, F.coalesce(F.get(g, k)["at"], F.size(lines)) - end(k)))
        return F.flatten(kept)
    return let(gone, rest)


def remove_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` rid of repeated chunks, plus ``removed_chunks`` and ``removed_lines``."""
    texts = docs.select("doc_id", "text")
    # the place as one number, so that the count is a hash aggregate of fixed width
    repeated = stage(_pairs(texts).select("h", F.xxhash64("doc_id", "digest", "at").alias("p"))
                     .groupBy("h").agg(F.min("p").alias("a"), F.max("p").alias("b"))
                     .filter("a <> b").select("h"), "repeated")
    found = stage(_chunks(texts, repeated).withColumn("h", F.xxhash64("chunk")), "occurrences")
    place = F.struct("doc_id", "digest", "at")
    # written first, so that the join deals its sides anew and adaptive execution can split a hot chunk
    first = stage(found.groupBy("h", "chunk").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                  .filter("a <> b").select("h", "chunk", "a"), "first")
    gone = found.join(first, ["h", "chunk"]).filter(place != F.col("a")) \
        .groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")) \
        .agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("_gone"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text")
    kept = F.array_join(let(_lines(text), lambda lines: _without(lines, F.col("_gone"))), "\n")
    joined = row.join(gone, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.md5(text) == F.col("_digest")), "left") \
        .withColumn("kept", F.when(F.col("_gone").isNotNull(), kept))
    return joined.select(
        *[F.coalesce("kept", text).alias("text") if c == "text" else F.col(f"row.`{c}`")
          for c in docs.columns if c not in ("removed_chunks", "removed_lines")],
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("removed_chunks"),
        F.coalesce(F.aggregate("_gone", F.lit(0), lambda s, c: s + c["n"]), F.lit(0)).cast("long").alias("removed_lines"))


ORACLE_SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT *, row_number() OVER () AS d, string_split(text, chr(10)) AS lines FROM docs),
lines AS (SELECT d, doc_id, md5(text) AS digest, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM numbered),
hashed AS (SELECT *, CAST('0x' || md5(line)[1:8] AS BIGINT) AS v, lag(line) OVER w AS prev FROM lines WINDOW w AS (PARTITION BY d ORDER BY i)),
paired AS (SELECT *, i > 0 AND count(*) OVER (PARTITION BY prev, line) > 1 AS s, v + {FACTOR} * lag(v) OVER w AS r
    FROM hashed WINDOW w AS (PARTITION BY d ORDER BY i)),
cut AS (SELECT *, NOT s OR coalesce(lag(s) OVER w AND lead(s) OVER w AND r < lag(r) OVER w AND r < lead(r) OVER w, FALSE) AS opens
    FROM paired WINDOW w AS (PARTITION BY d ORDER BY i)),
placed AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY d ORDER BY i) AS c FROM cut),
chunks AS (SELECT d, c, doc_id, digest, min(i) AS a, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk
    FROM placed GROUP BY d, c, doc_id, digest HAVING count(*) > 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id NULLS FIRST, digest, a) AS k FROM chunks),
gone AS (SELECT d, c, n FROM ranked WHERE k > 1),
kept AS (SELECT d, string_agg(line, chr(10) ORDER BY i) AS text FROM placed p
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.d = p.d AND g.c = p.c) GROUP BY d),
sums AS (SELECT d, count(*) AS chunks, sum(n) AS lines FROM gone GROUP BY d)
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
    CAST(coalesce(s.chunks, 0) AS BIGINT) AS removed_chunks,
    CAST(coalesce(s.lines, 0) AS BIGINT) AS removed_lines
FROM documents o LEFT JOIN numbered b ON o.doc_id IS NOT DISTINCT FROM b.doc_id AND o.text = b.text
LEFT JOIN kept k ON k.d = b.d LEFT JOIN sums s ON s.d = b.d
"""
