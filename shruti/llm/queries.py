"""The registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontamination, media, near_copies, packing, quality, repeats, secrets, surrogates, wrappers
from .common import table


def pii_key(spark: SparkSession) -> bytes:
    """The secret key of surrogates, from the session's settings; the default is for tests only."""
    return (spark.conf.get("spark.shruti.pii.key", None) or "not-a-production-key").encode()


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_media(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.spans(table(spark, sf_dir, "documents"))


def op4_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.digest(table(spark, sf_dir, "documents"), pii_key(spark))


def op6_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.digest(table(spark, sf_dir, "documents"))


def op9_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.linked(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_media, op2_packing, op3_sparse_suffixes, op4_wrappers, op5_surrogates, op6_fm_index, op7_secrets, op8_quality, op9_near_copies, op9_links, op10_decontamination)}

