"""Corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes every
stage's result as Parquet in the shared folder and reads it back for the next, so a
lost executor costs the running stage only. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, language_model, line_dedup, near_duplicates
from tidemark.llm.registry import read, tokenizer_path
from tidemark.session import staged


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language-model perplexity lies within their language's limit."""
    return language_model.keep_accepted(docs, read(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without later copies of runs of twenty words or more."""
    return line_dedup.drop_repeated_lines(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, over the operator's own five-word shingles."""
    return near_duplicates.keep_first(docs)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them."""
    return bpe.encoded(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("ids"))


STAGES = [
    ("quality_classifier", accept_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_benchmark_texts),
    ("bpe", encode),
]

#: The stages rest on a trained model and on a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
