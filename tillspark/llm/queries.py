"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.llm import (
    chat,
    decontaminate,
    htmltext,
    licenses,
    mixing,
    negatives,
    packing,
    quality,
    setjoin,
    sql,
    surrogates,
    toxicity,
    warc,
    whitening,
)
from tillspark.session import ship_package, staged

TOKENIZER = "word_bpe_49k.json"
# stands in for a secret that a deployment supplies
SURROGATE_KEY = b"registered query"

QUERIES = {}
ORACLE = {
    "op1_warc": sql.OP1,
    "op8_ngram_jaccard_join": sql.OP8,
    "op12_source_mixing": sql.OP12,
    "op13_hard_negatives": sql.OP13,
}


def query(function):
    """Register ``function`` under its own name; its workers get this package."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and the component it is linked into."""
    return setjoin.similar_components(table(spark, sf_dir, "documents"))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that leaked into it."""
    return decontaminate.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text statistics, likelihood ratio and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "quality.*")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    pieces = packing.packed_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(docs, SURROGATE_KEY)


@query
def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licenses it names."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record in the archives says, after writing and reading them."""
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    return htmltext.main_texts(table(spark, sf_dir, "pages"))


@query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its repaired role and its part of the rendered conversation."""
    return chat.repaired(table(spark, sf_dir, "conversations"))


@query
def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix of sources takes of it."""
    docs = table(spark, sf_dir, "documents")
    sized = staged(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-sizes")
    return mixing.with_mix(sized, size="size").select("doc_id", "mix.*")


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector with its first eight whitened components."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after a seventh of the labels moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)
