"""From raw documents to token ids: rules, line and document deduplication, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame; run() writes it as
Parquet and reads it again as the next one's documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.llm import adapt_join, bpe, decision_list, line_dedup, mixing
from alertlens.llm.common import materialize, table
from alertlens.llm.queries import word_vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the rules learned from the labels keep."""
    return decision_list.keep_good(docs, table(spark, sf_dir, "labels"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one repeats; n_chars follows the text."""
    out = line_dedup.without_repeats(docs, short=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares its five-word shingles to 0.8 or more."""
    return adapt_join.one_of_each_group(docs)


def weighted_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every document."""
    return bpe.encode(docs, word_vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", unique_lines),
    ("n-gram Jaccard join", unique_documents),
    ("source mixing", weighted_sources),
    ("BPE", token_ids),
]

#: the learned rules and the encoding have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
