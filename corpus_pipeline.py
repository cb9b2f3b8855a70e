"""Corpus pipeline: quality, near copies, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it
kept, and returns the columns of ``documents`` but for the last, which returns
packed pieces. Stages are written as Parquet and reread in between.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shruti.llm import decontamination, near_copies, packing, quality, surrogates
from shruti.llm.common import bound_batches, stored, table
from shruti.llm.queries import pii_key


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of five words, similarity 0.8 or more) the first document stays."""
    bound_batches(spark)
    return near_copies.keep_one(docs, width=5, percent=80)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    surrogates.confirm(docs, pii_key(spark))
    return surrogates.pseudonymise(docs, pii_key(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES = [("quality", good_quality), ("near_copies", no_near_copies), ("decontamination", no_benchmark), ("pii", no_personal_data), ("packing", packed)]

#: No SQL expresses the classifier, the surrogates or the packing; the tests run the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
