"""A corpus pipeline: quality, exact and near duplicates, mixing, encoding.

All stages but the last return the columns of documents, whatever further columns these have. A null
text counts as empty, repeated rows are rows of their own unless a stage says otherwise, an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, exact_dedup, mixing, near_dedup, quality_classifier
from tickloom.session import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier rejects go.

    Empty and null texts are scored like others; a repeated id keeps or loses each row by its own text;
    with nothing to learn from the model knows no difference and all stay.
    """
    model = quality_classifier.train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without their blanks the longest, then the smallest doc_id stays.

    Null, empty and blank texts are equal to each other, so that one of them stays; of rows equal in
    id and length one stays.
    """
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 of their five-word shingles the smallest doc_id stays.

    Texts without words are linked with nothing and stay; rows equal in id and text stay or go together.
    """
    return near_dedup.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document, pass and shard with the words that the shard draws of the document.

    Texts without words have no row; a null source is a source of its own; equal rows are drawn one by one.
    """
    return mixing.mix(docs).select(*_all(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what the mix holds, row by row; an empty text has no tokens."""
    return bpe.encode_digests(docs, bpe.default_tokenizer())


def _all(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("bpe", encoded)]
#: Learned scores, hash permutations and BPE are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again as the next one's, and then deleted."""
    docs, hold = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        before, docs = docs, hold.write(stage(spark, docs, sf_dir), name)
        hold.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
