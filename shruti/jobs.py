"""Whole jobs: from a corpus' files and a model to result files and a summary.

Each job runs the model once, keeps its rows on the executors' disks while the
files are written (lost ones are made again), and returns its summary's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backends, schemas
from .functions import ctc
from .functions.textnorm import strip
from .operators import corpus_eval, crosscheck, joins, qc
from .sinks import files
from .sources import audio, kaldi, tables

Make = Callable[[], backends.Backend]
#: Columns of an utterance that go through a model beside its samples.
UTTERANCE = ("utt_id", "spk_id", "rec_id", "start", "end", "reference")
SUMMARY = "split string, n long, n_skipped long, avg_wer double, avg_cer double, corpus_wer double, corpus_cer double"


def split_files(spark: SparkSession, folder: str) -> dict[str, DataFrame | None]:
    """text, wav_scp, segments and utt2spk of a Kaldi folder; the last two are None where there is no file."""
    there = lambda name: kaldi.exists(spark, f"{folder}/{name}")
    for name in ("text", "wav.scp"):
        if not there(name):
            raise FileNotFoundError(f"{folder}/{name}")
    read = lambda name: kaldi.lines(spark, f"{folder}/{name}")
    return {
        "text": kaldi.text(read("text")), "wav_scp": kaldi.wav_scp(read("wav.scp")),
        "segments": kaldi.segments(read("segments")) if there("segments") else None, "utt2spk": kaldi.utt2spk(read("utt2spk")) if there("utt2spk") else None,
    }


def transcribed(rows: DataFrame, make: Make, language: str, marker: str, rounding: str, carry: tuple[str, ...]) -> DataFrame:
    """``carry`` columns with hypothesis; where audio or model fails, it is the marker."""
    read = audio.cuts(rows, rounding)
    return backends.marked(backends.transcribe(read, make, language, carry=carry), marker).drop("error")


def evaluate_kaldi(spark: SparkSession, root: str, splits: list[str], out: str, make: Make, language: str, decoder: str = "ctc") -> DataFrame:
    """Results and manifest of each split below a root that is there, and summary.txt; returns the summary.

    A split without its folder is left out; its files are ``split_results.csv`` and ``split_manifest.json``.
    """
    found = None
    for split in splits:
        if not kaldi.exists(spark, f"{root}/{split}"):
            continue
        k = split_files(spark, f"{root}/{split}")
        rows = joins.utterances(joins.located(k["text"], k["segments"], k["wav_scp"]), k["utt2spk"])
        rows = rows.select(*UTTERANCE[:-1], F.col("transcript").alias("reference"), F.col("audio_source").alias("path"))
        results = corpus_eval.evaluate(transcribed(rows, make, language, corpus_eval.AUDIO_FAILED, "joint", UTTERANCE)).persist(StorageLevel.DISK_ONLY)
        try:
            files.write_csv(results, f"{out}/{split}_results.csv", schemas.EVAL_COLUMNS)
            whole = None if k["segments"] is not None else audio.lengths(k["wav_scp"].select(F.trim("audio_source").alias("path")).distinct())
            files.write_manifest(joins.manifest_rows(results, k["segments"], k["wav_scp"], whole), f"{out}/{split}_manifest.json")
            one = corpus_eval.summarize(results.withColumn("split", F.lit(split)), "split").collect()  # a row for each split
        finally:
            results.unpersist()
        found = (found or []) + one
    summary = spark.createDataFrame([tuple(r) for r in found or []], SUMMARY)
    files.write_summary(summary, f"{out}/summary.txt", decoder, language)
    return summary


def evaluate_folder(spark: SparkSession, folder: str, out: str, make: Make, language: str, audio_dir: str = "audio_16k", text_dir: str = "transcripts") -> DataFrame:
    """Results of a folder's pairs of audio and transcript, matched by name on one level; returns counts and error rates.

    An empty reference gives -1 for its rates and is left out of the summary.
    """
    for sub in (audio_dir, text_dir):
        if not kaldi.exists(spark, f"{folder}/{sub}"):
            raise FileNotFoundError(f"{folder}/{sub}")
    pairs = audio.folder_pairs(audio.listed(spark, f"{folder}/{audio_dir}", ".wav"), audio.listed(spark, f"{folder}/{text_dir}", ".txt"))
    both = joins.matched(pairs).select("stem", F.col("audio_path").alias("path"))
    counts = pairs.agg(F.count("audio_path").alias("audio_files"), F.count("transcript_path").alias("transcript_files"), F.count(F.when(F.col("audio_path").isNotNull() & F.col("transcript_path").isNotNull(), 1)).alias("pairs"))
    if kaldi.exists(spark, f"{folder}/{text_dir}/*.txt"):
        texts = audio.read_transcripts(spark, f"{folder}/{text_dir}")
    else:
        texts = spark.createDataFrame([], "stem string, transcript string")
    # an empty file has no row among the texts
    rows = both.join(texts, "stem", "left").select(
        F.col("stem").alias("utterance_id"), F.regexp_replace("path", "^file:/+", "/").alias("audio_path"), F.coalesce("transcript", F.lit("")).alias("reference"), "path",
        F.lit(None).cast("double").alias("start"), F.lit(None).cast("double").alias("end"),
    )
    results = corpus_eval.evaluate(transcribed(rows, make, language, corpus_eval.INFERENCE_FAILED, "offset_first", ("utterance_id", "audio_path", "reference"))).persist(StorageLevel.DISK_ONLY)
    try:
        files.write_csv(results.orderBy("utterance_id"), out, schemas.FOLDER_COLUMNS)
        rates = [tuple(r) for r in corpus_eval.summarize(results.withColumn("split", F.lit("all")), "split").collect()]
    finally:
        results.unpersist()
    return counts.join(spark.createDataFrame(rates, SUMMARY).drop("split"), how="left", on=F.lit(True))


def check_transcripts(spark: SparkSession, results: str, out: str, make: Make, language: str) -> DataFrame:
    """All rows of a results CSV with a third transcript, its similarities and category, and the flagged ones; returns the categories' counts."""
    rows = tables.read_csv(spark, results, schemas.CROSSCHECK)
    rows = rows.withColumnRenamed("hypothesis", "given")  # the model's own text comes under that name
    carry = tuple(rows.columns)
    times = {"start": F.coalesce(F.col("start_sec").try_cast("double"), F.lit(0.0)), "end": F.coalesce(F.col("end_sec").try_cast("double"), F.lit(0.0)), "path": F.col("audio_path")}
    read = audio.cuts(rows.withColumns(times), "ends")
    heard = backends.transcribe(read, make, language, carry=(*carry, "start", "end", "audio_error"))
    failed = F.col("audio_error").isNotNull()
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in carry}
    heard = heard.withColumns({**texts, "whisper_error": F.when(~failed, F.col("error")), "whisper": strip(F.coalesce(F.col("hypothesis"), F.lit("")))})
    heard = heard.drop("hypothesis").withColumnRenamed("given", "hypothesis")
    checked = crosscheck.crosscheck(heard)
    said = F.when(failed, F.concat(F.lit("ERROR:"), "audio_error")).when(F.col("whisper_error").isNotNull(), F.concat(F.lit("ERROR:"), "whisper_error")).otherwise(F.col("whisper"))
    checked = checked.withColumns({"whisper": said, "start_sec": F.col("start"), "end_sec": F.col("end")}).withColumnsRenamed({"wer": "wer_orig", "cer": "cer_orig"})
    checked = checked.select(*schemas.CROSSCHECK_COLUMNS).persist(StorageLevel.DISK_ONLY)
    try:
        files.write_csv(checked, f"{out}/audio_analysis_results.csv")
        files.write_csv(crosscheck.flagged(checked), f"{out}/audio_analysis_flagged.csv")
        counts = [tuple(r) for r in crosscheck.histogram(checked).collect()]  # a row for each category
    finally:
        checked.unpersist()
    return spark.createDataFrame(counts, "category string, n long, percent double")


def check_alignment(
    spark: SparkSession, folder: str, out: str, make: Make, vocabulary: list[str], threshold: float = qc.SCORE_THRESHOLD, min_token: float | None = None, part: ctc.Slice | None = None,
) -> DataFrame:
    """Quality report of a Kaldi folder's utterances, lists of accepted and rejected ids; returns the summary.

    vocabulary: the pieces that the model's block stands for; part: the block, by
    default all outputs but the last, which is the blank. A segment whose
    recording is unknown is rejected; a transcript without segment is none.
    """
    k = split_files(spark, folder)
    part = ctc.language_slice(len(vocabulary) + 1) if part is None else part
    rows = joins.located(k["text"], k["segments"], k["wav_scp"])
    rows = rows.where(F.coalesce(F.col("reason"), F.lit("")) != (joins.NO_RECORDING if k["segments"] is None else joins.NO_SEGMENT))
    lost = F.when(F.col("reason").isNotNull(), F.concat(F.lit("recording '"), "rec_id", F.lit("' not in wav.scp")))
    rows = rows.select("utt_id", F.col("transcript").alias("text"), F.col("audio_source").alias("path"), "rec_id", "start", "end", lost.alias("lost"))
    read = audio.cuts(rows).withColumn("audio_error", F.coalesce("lost", "audio_error"))
    heard = backends.frames(read, make, carry=("utt_id", "text", "path", "rec_id", "start", "end", "wav", "seconds", "audio_error")).withColumnRenamed("error", "model_error")
    none = F.array().cast("array<array<double>>")
    scored = heard.withColumns({
        "frames": F.coalesce(F.when(F.col("audio_error").isNull(), ctc.sliced(F.col("frames"), part)), none), "target": ctc.text_to_ids(vocabulary)(F.col("text")),
        "audio_duration": F.col("seconds"), "path": F.coalesce("path", "rec_id"), "first_error": F.coalesce("audio_error", "model_error"),
    })
    scored = qc.score(scored, part.width + 1, part.width).withColumns({"error": F.coalesce("first_error", "error"), "snr": F.coalesce("snr", F.lit(float("nan")))})
    report = qc.report(scored, vocabulary, threshold, min_token).persist(StorageLevel.DISK_ONLY)
    try:
        files.write_accepted(report, out)
        summary = qc.summary(report)
        rows = summary.collect()  # one row
    finally:
        report.unpersist()
    return spark.createDataFrame(rows, summary.schema)
