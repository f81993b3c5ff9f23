"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.llm import fingerprints, jaccard, licenses, mixing, pieces, pii, quality, repeats, topk, toxicity
from slidemill.llm.common import table
from slidemill.llm.packing import pack
from slidemill.llm.tokens import token_counts
from slidemill.llm.trie import prefix_trie

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

# target weights of the mixing query
WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}, "source": {"src0": 2}}


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).drop("digest", "found")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held=0, threshold=0.5)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=4, num=85, den=100)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=4, held=2, threshold=0.7)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, share=(6, 10), max_epochs=2, seed=42)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=2048)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"), every_copy=True)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), size=2048, end_id=1)


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, query_every=100)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), end=True, decoded=True))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), group=100, heads=6)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return repeats.digests(repeats.periodic_runs(docs.select("doc_id", repeats.planted(F.col("doc_id"), F.col("text")).alias("text")), least=12))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_toxicity, op3_ngram_jaccard, op4_quality, op5_mixing, op6_token_counts, op7_license_scan, op8_fingerprints, op9_packing, op10_exact_top_k,
        op11_sentencepiece, op12_prefix_trie, op13_periodic_runs,
    )
}
ORACLES = {
    "op3_ngram_jaccard": jaccard.oracle_sql(),
    "op5_mixing": mixing.oracle_sql(WEIGHTS, (6, 10), 2, 42),
    "op7_license_scan": licenses.oracle_sql(),
    "op10_exact_top_k": topk.SQL,
}
