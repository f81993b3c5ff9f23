"""A training corpus from ``documents``: drop toxic texts, near copies, personal data; mix sources; pack.

``STAGES`` are applied in order, each over all rows its predecessor kept. All but the last return the columns of
``documents``, extra ones included; the last returns the packed pieces. An empty table passes through all of them. The stages
set the session's Arrow batches to ``BATCH_ROWS`` rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from slidemill.llm.common import shared_folder, table, trim_driver
from slidemill.llm.jaccard import keep_one
from slidemill.llm.mixing import keep_mixed
from slidemill.llm.packing import pack
from slidemill.llm.pii import redact
from slidemill.llm.queries import TOKENIZER, WEIGHTS
from slidemill.llm.toxicity import drop_toxic


#: Rows of a batch that Spark hands to Python. Documents are long: the default of ten thousand makes batches of tens of MB on both sides.
BATCH_ROWS = "1000"


def prepare(spark: SparkSession) -> None:
    """A stage begins with small batches, and with a driver that has given back what the stages before it have freed."""
    trim_driver(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go.

    Null and empty texts have no evidence and stay; rows of null ids and repeated rows are judged by their texts.
    """
    prepare(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more stays, the one of smallest id.

    Null and empty texts link with nothing and stay; of rows that repeat an id (or a null id) and its text one stays;
    rows of null ids are not compared with others.
    """
    prepare(spark)
    return keep_one(docs, size=5, num=80, den=100)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; ``n_chars`` follows. Rows are neither dropped nor added, null texts stay null."""
    prepare(spark)
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, by the target weights of the sources.

    Null texts have no tokens, null languages and sources are the value ''; rows that repeat an id stay or go together.
    """
    prepare(spark)
    return keep_mixed(docs, WEIGHTS, share=(9, 10))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens. Null and empty texts are one piece, the end id; repeated rows are packed as often as they stand."""
    prepare(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER), size=2048, end_id=1, remembered=100_000)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard), ("pii", pii), ("mixing", mixing), ("packing", packing)]

#: Toxicity, near copies and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
