"""The corpus pipeline: quality, line and near duplicates, personal data, packing, each stage stored as parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import stored, table
from quayside.llm.line_dedup import dedup_lines
from quayside.llm.ngram_join import keep_first
from quayside.llm.packing import pack
from quayside.llm.pii import redact_pii
from quayside.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of the documents it is given."""
    return keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; a document that loses all its lines goes."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar five-word shingles one stays."""
    return keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to marks."""
    return redact_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents and their places in sequences of 4,096 tokens."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("best_fit_packing", packing),
]

# Neither the network, the signatures nor the token ids can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder, writing and rereading between them."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
