"""The registered queries: each operator over a whole view."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ctc, editdist, recording, signal, textnorm
from ..functions.binding import let
from ..operators import audit, corpus_eval, crosscheck, joins, qc
from ..sinks import files
from ..sources import audio, kaldi
from . import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Text and error rates


@query
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = views.spread(views.table(spark, sf_dir, "documents"))
    return d.select("doc_id", textnorm.normalize(F.coalesce("text", F.lit(""))).alias("normalized"))


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_eval.evaluate(views.transcripts(spark, sf_dir))


@query
def utt_wer_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluated(spark, sf_dir).select("utt_id", "ref_normalized", "hyp_normalized", "WER", "CER")


@query
def corpus_wer_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_eval.summarize(evaluated(spark, sf_dir), "split")


@query
def corpus_wer_cer_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_eval.summarize(evaluated(spark, sf_dir), "split", compat_failed_rows=True)


@query
def word_edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = views.transcripts(spark, sf_dir)
    ref, hyp = F.col("reference"), F.coalesce("whisper", F.lit(""))
    return t.select("utt_id", editdist.word_edits(ref, hyp).cast("long").alias("word_edits"), F.size(textnorm.words(ref)).cast("long").alias("ref_words"))


@query
def summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = corpus_wer_cer(spark, sf_dir)
    return s.select(files.summary_line(*(F.col(c) for c in ("split", "n", "corpus_wer", "corpus_cer", "avg_wer"))).alias("line"))


# Cross-check


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.transcripts(spark, sf_dir).withColumn("audio_error", F.when(F.col("hypothesis").isNull(), "no audio"))
    return crosscheck.crosscheck(rows)


@query
def jaccard_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir).select("utt_id", "wjac_whisper_ref", "wjac_whisper_hyp", "cjac_whisper_ref", "cjac_whisper_hyp", "category")


@query
def category_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosscheck.histogram(checked(spark, sf_dir))


@query
def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosscheck.flagged(checked(spark, sf_dir)).select("utt_id", "category")


# Readers


@query
def kaldi_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kaldi.text(views.document_lines(spark, sf_dir)).select("source", "utt_id", "transcript", "line_no")


@query
def kaldi_wav_scp(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = kaldi.wav_scp(views.document_lines(spark, sf_dir))
    return read.select("source", "rec_id", "audio_source", recording.is_pipe(F.col("audio_source")).alias("is_pipe"))


@query
def kaldi_utt2spk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kaldi.utt2spk(views.document_lines(spark, sf_dir)).select("source", "utt_id", "spk_id", "line_no")


@query
def kaldi_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kaldi.segments(views.segment_lines(spark, sf_dir)).select("source", "utt_id", "rec_id", "start_sec", "end_sec", "line_no")


@query
def malformed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kaldi.malformed_segments(views.segment_lines(spark, sf_dir)).select("source", "line_no", "line")


@query
def kaldi_utt2dur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kaldi.utt2dur(views.duration_lines(spark, sf_dir)).select("source", "utt_id", "duration")


# Joins


def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as one split whose wav.scp are the customers not in debt."""
    wav = views.customers(spark, sf_dir).where("c_acctbal >= 0").groupBy("rec_id").agg(F.max(views.entry()).alias("audio_source"))
    return joins.located(views.text(spark, sf_dir), views.segments(spark, sf_dir), wav)


@query
def segment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.utterances(_split_rows(spark, sf_dir), views.utt2spk(spark, sf_dir)).select("utt_id", "spk_id", "rec_id", "start", "end", "transcript", "audio_source")


@query
def unsegmented_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = joins.located(views.text(spark, sf_dir), None, views.wav_scp(spark, sf_dir))
    return rows.select("utt_id", "rec_id", "start", "end", "reason")


@query
def missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_rows(spark, sf_dir).where("reason is not null").select("utt_id", "rec_id", "reason")


@query
def join_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.losses(_split_rows(spark, sf_dir))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, labels = views.table(spark, sf_dir, "documents").where("lang <> 'es'"), views.table(spark, sf_dir, "labels")
    a = d.select(F.concat(F.lit("/c/audio_16k/d."), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"))
    t = labels.select(F.concat(F.lit("/c/transcripts/d."), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    return audio.folder_pairs(a, t)


@query
def pair_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.matched(_pairs(spark, sf_dir))


@query
def pair_no_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.matched(_pairs(spark, sf_dir), "audio").select("stem", "audio_path")


@query
def pair_no_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.matched(_pairs(spark, sf_dir), "transcript").select("stem", "transcript_path")


@query
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = views.text(spark, sf_dir).select("utt_id", F.col("transcript").alias("ref_normalized"))
    wav = views.customers(spark, sf_dir).where("c_acctbal >= 0").groupBy("rec_id").agg(F.max(views.entry()).alias("audio_source"))
    return joins.manifest_rows(results, views.segments(spark, sf_dir), wav)


# Audit


@query
def classify_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = views.customers(spark, sf_dir).withColumn("c", recording.classify(F.col("rec_id")))
    return c.select("c_custkey", "rec_id", "c.family", "c.speaker", "c.base", recording.band(F.col("rec_id")).alias("band"))


@query
def path_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.resolved(spark, sf_dir)


@query
def page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First path of each file name among page addresses, as an audio index is made."""
    path = F.regexp_replace("url", r"\?.*$", "")
    p = views.table(spark, sf_dir, "pages").select(recording.basename(path).alias("basename"), path.alias("path"))
    return p.groupBy("basename").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n"))


@query
def audit_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.waterfall(views.text(spark, sf_dir), views.segments(spark, sf_dir), views.resolved(spark, sf_dir))
    return rows.select("corpus", "split", "utt_id", "rec_id", "resolution", "reason", "segmented")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(views.text(spark, sf_dir), views.segments(spark, sf_dir), views.resolved(spark, sf_dir), views.utt2spk(spark, sf_dir), views.utt2dur(spark, sf_dir))


@query
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, sf_dir)


@query
def audit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.totals(report(spark, sf_dir))


@query
def audit_across_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.across_splits(audit.waterfall(views.text(spark, sf_dir), views.segments(spark, sf_dir), views.resolved(spark, sf_dir)))


@query
def audit_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.demographics(audit.waterfall(views.text(spark, sf_dir), views.segments(spark, sf_dir), views.resolved(spark, sf_dir)))


# Signal and alignment


@query
def wada_snr(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = views.waveforms(spark, sf_dir).withColumn("v3", signal.level_statistic(F.col("wav")))
    return w.select("vec_id", F.round("v3", 4).alias("statistic"), F.round(signal.wada_snr(F.col("wav"), statistic=F.col("v3")), 4).alias("snr"))


@query
def segment_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many samples each way of rounding gives a segment of a waveform of 64 samples, at one sample a second."""
    li = views.table(spark, sf_dir, "lineitem")
    wav, rate = F.array_repeat(F.lit(0.5), 64), F.lit(1.0)
    start, end = F.col("l_discount") * 100, F.col("l_discount") * 100 + F.col("l_quantity") + F.col("l_tax") * 10 - 2
    sizes = [F.size(signal.segment(wav, rate, start, end, how)).cast("long").alias(how) for how in ("offset_first", "joint", "ends")]
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *sizes)


@query
def unit_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loud samples are 32-bit floats, as the quiet ones are. As in SQL, a sum leaves nulls out, is null without samples, and -0.0 where a negative one rounds to zero."""
    w = views.waveforms(spark, sf_dir).withColumn("loud", F.transform("wav", lambda x: x * F.lit(30000).cast("float")))
    peak = lambda c: F.round(F.array_max(F.transform(signal.unit_scaled(c), F.abs)), 4)
    both = F.aggregate(signal.mono(F.array("wav", "loud")), F.lit(None).cast("double"), lambda s, x: F.coalesce(F.coalesce(s, F.lit(0.0)) + x, s))
    mono_sum = let(both, lambda s: F.signum(s) * F.round(F.abs(s), 0))
    return w.select("vec_id", peak(F.col("wav")).alias("quiet_peak"), peak(F.col("loud")).alias("loud_peak"), mono_sum.alias("mono_sum"))


@query
def log_softmax_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = ctc.language_slice(8, offsets={"x": 2}, language="x", width=3)
    s = views.scored_frames(spark, sf_dir).select("vec_id", ctc.sliced(F.col("frames"), part).alias("f"))
    return s.select("vec_id", F.posexplode("f").alias("t", "f")).select("vec_id", F.col("t").cast("long").alias("t"), *(F.round(F.get("f", F.lit(i)), 4).alias(f"c{i}") for i in range(4)))


@query
def ctc_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = views.scored_frames(spark, sf_dir)
    return s.select("vec_id", ctc.ids_to_text(ctc.greedy(F.col("frames"), views.BLANK), None).alias("ids"), F.round(ctc.greedy_logprob(F.col("frames")), 4).alias("greedy_logprob"))


def scored(spark: SparkSession, sf_dir: str, with_path: bool) -> DataFrame:
    return qc.score(views.scored_frames(spark, sf_dir), views.CLASSES, views.BLANK, with_path=with_path)


@query
def forced_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir, False)
    return s.select("vec_id", "error", *(F.round(c, 4).alias(c) for c in ("forced_logprob", "greedy_logprob", "score", "lr_per_frame")))


@query
def qc_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, False).select("vec_id", F.round("score", 4).alias("score"), qc.passes(-1.5).alias("pass"))


@query
def qc_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.summary(scored(spark, sf_dir, False).withColumn("pass", qc.passes(-1.5)))


@query
def token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and times of the best path; which of equal paths is best SQL can't say, so there is none."""
    s = scored(spark, sf_dir, True)
    return s.select("vec_id", *(F.round(c, 4).alias(c) for c in ("mean_token_score", "min_token_score", "start_time", "end_time")), F.coalesce(F.size("token_boundaries"), F.lit(0)).alias("tokens"))


@query
def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir, True).withColumns({"utt_id": F.col("vec_id").cast("string"), "text": F.lit(""), "path": F.lit("/a.wav"), "start": F.lit(0.0), "end": F.col("audio_duration")})
    return qc.report(rows, list("▁abcdef"), threshold=-1.5, min_token=-6.0)


# Files


@query
def resample_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waveforms as 8 kHz files: their headers, and what converting gives."""

    @F.pandas_udf("binary")
    def as_file(wavs: pd.Series) -> pd.Series:
        return wavs.map(lambda w: audio.encode(w, 8000))

    stored = views.waveforms(spark, sf_dir).select(F.col("vec_id").cast("string").alias("path"), as_file("wav").alias("content"))
    heads = stored.withColumn("h", audio.probe("content"))
    heads = heads.select("path", "h.sample_rate", "h.channels", "h.frames", audio.needs_conversion(F.col("h.sample_rate"), F.col("h.channels")).alias("needs_conversion"))
    done = audio.convert(stored).select("path", "status", F.round("seconds", 4).alias("seconds"))
    return heads.join(done, "path")


@query
def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs whose converted files would collide: part names as a tree, by type and brand."""
    p = views.table(spark, sf_dir, "part")
    path = F.concat(F.lit("/in/"), "p_type", F.lit("/"), "p_brand", F.when(F.col("p_size") > 25, ".flac").otherwise(".mp3"))
    paths = p.select(path.alias("path")).distinct().withColumn("out", audio.output_path(F.col("path"), "/in", "/out"))
    return audio.collisions(paths, "out")


@query
def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.chunk_of(views.table(spark, sf_dir, "orders").select("o_orderkey"), 4, "o_orderkey")


@query
def rate_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample rates among the first ten files, which is the report a dry run makes."""
    d = views.table(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", "p_name", F.col("p_partkey").cast("string")).alias("path"), (F.col("p_size") * 1000).alias("rate"))
    first = audio.first_files(d).withColumn("needs", audio.needs_conversion(F.col("rate"), F.lit(1)))
    return first.groupBy("rate").agg(F.count(F.lit(1)).alias("n"), audit.count_if(F.col("needs")).alias("to_convert"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
