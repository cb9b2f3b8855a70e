"""Joins of transcripts, segments, recordings and speakers, with a reason for every row that doesn't come through.

Join sides are left to the planner: small ones are broadcast by their measured
size, large ones shuffled, skewed ones split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import recording

NO_SEGMENT, NO_RECORDING = "no_segment", "recording_missing"


def located(text: DataFrame, segments: DataFrame | None, wav_scp: DataFrame) -> DataFrame:
    """Every transcript with rec_id, start, end, audio_source and reason (null: complete). Without segments a recording is an utterance."""
    if segments is None:
        rows = text.withColumns({"rec_id": F.col("utt_id"), "start_sec": F.lit(None).cast("double"), "end_sec": F.lit(None).cast("double"), "_seg": F.lit(True)})
    else:
        rows = text.join(segments.select("utt_id", "rec_id", "start_sec", "end_sec", F.lit(True).alias("_seg")), "utt_id", "left")
    rows = rows.join(wav_scp.select("rec_id", "audio_source", F.lit(True).alias("_wav")), "rec_id", "left")
    reason = F.when(F.col("_seg").isNull(), NO_SEGMENT).when(F.col("_wav").isNull(), NO_RECORDING)
    return rows.select("utt_id", "rec_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "transcript", "audio_source", reason.alias("reason"))


def utterances(rows: DataFrame, utt2spk: DataFrame | None = None) -> DataFrame:
    """Complete rows of ``located`` with their speaker, "unknown" without one."""
    rows = rows.where("reason is null").drop("reason")
    if utt2spk is None:
        return rows.withColumn("spk_id", F.lit("unknown"))
    return rows.join(utt2spk.select("utt_id", "spk_id"), "utt_id", "left").withColumn("spk_id", F.coalesce("spk_id", F.lit("unknown")))


def losses(rows: DataFrame) -> DataFrame:
    """reason and n of what ``located`` couldn't complete."""
    return rows.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def matched(pairs: DataFrame, side: str = "both") -> DataFrame:
    """Of a full join on stems: what both sides have, or only audio, or only transcripts."""
    a, t = F.col("audio_path").isNotNull(), F.col("transcript_path").isNotNull()
    return pairs.where({"both": a & t, "audio": a & ~t, "transcript": t & ~a}[side])


def manifest_rows(results: DataFrame, segments: DataFrame | None, wav_scp: DataFrame, file_seconds: DataFrame | None = None) -> DataFrame:
    """audio_filepath, text, utt_id, duration, offset of each result. Pipes have an empty path; without segment the duration is the file's, 0 if unknown.

    file_seconds: path and seconds, for results without segment.
    """
    rows = results.select("utt_id", F.col("ref_normalized").alias("text"))
    if segments is None:
        rows = rows.withColumns({"rec_id": F.lit(None).cast("string"), "offset": F.lit(None).cast("double"), "_end": F.lit(None).cast("double")})
    else:
        rows = rows.join(segments.select("utt_id", "rec_id", F.col("start_sec").alias("offset"), F.col("end_sec").alias("_end")), "utt_id", "left")
    rows = rows.withColumn("rec_id", F.coalesce("rec_id", "utt_id")).join(wav_scp.select("rec_id", "audio_source"), "rec_id", "left")
    source = F.coalesce(F.col("audio_source"), F.lit(""))
    rows = rows.withColumn("audio_filepath", F.when(recording.is_pipe(source), "").otherwise(F.trim(source)))
    seconds: Column = F.lit(None).cast("double")
    if file_seconds is not None:
        rows = rows.join(file_seconds.select(F.col("path").alias("audio_filepath"), F.col("seconds").alias("_seconds")), "audio_filepath", "left")
        seconds = F.col("_seconds")
    duration = F.round(F.coalesce(F.col("_end") - F.col("offset"), seconds, F.lit(0.0)), 3)
    return rows.select("audio_filepath", "text", "utt_id", duration.alias("duration"), "offset")
