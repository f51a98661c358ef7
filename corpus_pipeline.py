"""Corpus pipeline: language ID, near-duplicate removal, decontamination, source mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again for the next.
All but the last return the columns of documents.  Nulls, empty tables and repeated rows are handled as the operators'
modules say; rows that a stage keeps are not changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import common, decontaminate, hyper_langid, jaccard_join, mixing, token_store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told; those without a letter go."""
    return hyper_langid.keep_identified(docs, hyper_langid.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, that with the smallest id."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold too much of the benchmark."""
    return decontaminate.keep_clean(docs, common.table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents so that sources come to their weights, in training order."""
    return mixing.mix(docs).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token store in training order, and return each document's digest from it.

    The mix has written its rows in training order, over files and within them; rows that come from no file are taken by id.
    """
    file, row = common.fresh_name(docs, "file"), common.fresh_name(docs, "row")
    try:
        part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
        placed = docs.select("*", part.alias(file), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        return token_store.token_digests(docs)
    return token_store.token_digests(placed, (file, row))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_to_weights),
    ("token-ID / binary output", write_tokens),
]

#: Tokenizing and the language profiles are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), "stage")
    return docs
