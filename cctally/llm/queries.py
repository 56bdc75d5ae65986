"""The registered queries of this package and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cctally.llm import (
    bpe, collocations, decontaminate, hamming, html_text, jaccard_join, language, line_dedup, packing, prefix_trie,
    suffix_tree, toxicity, warc)
from cctally.llm.common import held_out, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Folder of the public tokenizer files, when it is not the installed package's.
TOKENIZERS_ENV = "CCTALLY_TOKENIZERS"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file on the driver."""
    folder = os.environ.get(TOKENIZERS_ENV)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_line_dedup", line_dedup.ORACLE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file())


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda c: ~held_out(c, 3, 1))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op8_hamming_top_k", hamming.ORACLE_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    words = hamming.words_needed(vectors, "embedding")
    codes = hamming.binary_codes(vectors, "vec_id", "embedding", words)
    return hamming.top_k(codes, codes.filter(F.col("id") % 50 == 0), words=words)


@query("op9_warc", warc.ORACLE_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = warc.archive_folder(pages)
    index = warc.write_archives(pages, folder)
    return warc.read_archives(index, folder, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs, language.fit(docs, lambda c: ~held_out(c, 4, 2)))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "languages", "shares")


@query("op4_suffix_tree_lm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(table(spark, sf_dir, "documents"))


@query("op11_curve_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), keep_ids=False).drop("ids")


@query("op12_prefix_trie")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digests(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


@query("op13_collocations", collocations.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_collocations(table(spark, sf_dir, "documents"))
