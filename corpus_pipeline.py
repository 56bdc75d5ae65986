"""Corpus cleaning: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the
columns of ``docs``; rows that no stage objects to reach the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cctally.llm import bpe, decontaminate, jaccard_join, line_dedup, queries, toxicity
from cctally.llm.common import held_out, stage, table

#: No SQL: boosted trees, MinHash banding, local alignment and BPE are beyond it.
ORACLE_SQL = None


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and the whole row as one value, so that no column's name meets one of an operator's."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores at 0.7 or more go."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), lambda c: ~held_out(c, 3, 1))
    # the text beside the rest of its row, so that a task gets it once
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    kept = toxicity.score(docs.select("text", rest.alias("rest")), model).filter("score < 0.7")
    return kept.select(*[F.col("text" if c == "text" else f"rest.`{c}`") for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, and documents of which nothing is left."""
    out = line_dedup.remove_repeated_chunks(packed(docs))
    emptied = (F.col("removed_chunks") > 0) & (F.trim("text") == "")
    out = out.filter(~emptied | F.col("text").isNull())
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("text").isNull(), F.col("whole_row.n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(f"whole_row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked texts stays: that with the least id."""
    return jaccard_join.keep_one(packed(docs)).select("whole_row.*")


def drop_leaking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The surviving documents' BPE encodings, decoded again, as counts and digests."""
    return bpe.digests(docs, queries.tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaking),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
