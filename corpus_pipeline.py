"""The corpus pipeline: documents through the stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmark.llm import bpe, exact, mixing, ngrams, toxicity
from feedmark.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The machine learns from the labelled documents of this stage's input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the row with the largest doc_id stays."""
    return exact.drop_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links of five-word shingles with a Jaccard similarity of 0.8 or more connect, the smallest doc_id stays."""
    return ngrams.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, none to two times."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, a row for each document of the mix."""
    return bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_similar),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL cannot repeat the learned scores, the draws of the mix and the encoding; tests compare with a brute-force version.
ORACLE_SQL = None
