"""Result tables in CSV, with a header, quotes doubled and an optional byte order mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """The schema's columns by the names in the header, all as strings; columns that are missing are null."""
    read = spark.read.csv(path, header=True, sep=sep, multiLine=True, quote='"', escape='"', inferSchema=False)
    read = read.toDF(*(c.lstrip("﻿") for c in read.columns))
    names = [f.strip().split()[0] for f in schema.split(",")]
    return read.select(*((F.col(f"`{n}`") if n in read.columns else F.lit(None).cast("string")).alias(n) for n in names))


def from_eval(results: DataFrame, wav_scp: DataFrame) -> DataFrame:
    """Evaluation results with the column names that a cross-check reads."""
    joined = results.join(wav_scp.select("rec_id", F.col("audio_source").alias("audio_path")), "rec_id", "left")
    return joined.select(
        "utt_id", F.col("rec_id").alias("recording_id"), F.col("start").alias("start_sec"), F.col("end").alias("end_sec"), (F.col("end") - F.col("start")).alias("duration_sec"),
        F.coalesce("audio_path", F.lit("")).alias("audio_path"), "reference", "hypothesis", F.col("WER").alias("wer"), F.col("CER").alias("cer"),
    )
