"""Coverage audit: how many utterances of each corpus and split can be checked, and why the others can't.

One plan over all corpora and splits: ``corpus`` and ``split`` are columns, each
count is a conditional sum, and loss reasons are decided in order, first match
first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import recording
from ..functions.textnorm import strip

GRAIN = ["corpus", "split"]
LOSSES = ("no_segment", "not_in_wav_scp", "audio_missing", "empty_transcript")
GIVEN, INDEXED, UNRESOLVED = "as_given", "by_name", "unresolved"


def resolve_paths(wav_scp: DataFrame, present: DataFrame, index: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Recordings with how they resolve: the path as given, a file of its name or of the recording's name in the index, or not at all.

    present: column path of what exists; index: basename, path; extra: grain columns that all three may have.
    """
    grain = [c for c in (extra or []) if c in wav_scp.columns]
    shared = [c for c in grain if c in index.columns]
    rows = wav_scp.withColumn("_cand", recording.first_token(F.col("audio_source"))).withColumn("is_pipe", recording.is_pipe(F.col("audio_source")))
    rows = rows.withColumn("_name", F.when(F.col("_cand") != "", recording.basename(F.col("_cand"))).otherwise(F.concat("rec_id", F.lit(".wav")))).withColumn("_own", F.concat("rec_id", F.lit(".wav")))
    rows = rows.join(present.select(F.col("path").alias("_cand"), F.lit(True).alias("_there")).distinct(), "_cand", "left")
    for key, found in (("_name", "_by_name"), ("_own", "_by_own")):
        rows = rows.join(index.select(*shared, F.col("basename").alias(key), F.col("path").alias(found)), [*shared, key], "left")
    given = F.col("_there").isNotNull() & (F.col("_cand") != "") & ~F.col("_cand").endswith("|")
    path = F.when(given, F.col("_cand")).otherwise(F.coalesce("_by_name", "_by_own"))
    how = F.when(given, GIVEN).when(path.isNotNull(), INDEXED).otherwise(UNRESOLVED)
    return rows.select(*grain, "rec_id", "audio_source", "is_pipe", path.alias("path"), how.alias("resolution"))


def waterfall(text: DataFrame, segments: DataFrame, resolved: DataFrame) -> DataFrame:
    """Each utterance with its recording, reason of loss (null: verifiable), class and seconds. A split without segments has one recording per utterance."""
    segmented = segments.select(*GRAIN).distinct().withColumn("_segmented", F.lit(True))
    rows = text.join(segmented, GRAIN, "left").withColumn("_segmented", F.coalesce("_segmented", F.lit(False)))
    rows = rows.join(segments.select(*GRAIN, "utt_id", F.col("rec_id").alias("_rec"), "start_sec", "end_sec"), [*GRAIN, "utt_id"], "left")
    rows = rows.withColumn("rec_id", F.when(F.col("_segmented"), F.col("_rec")).otherwise(F.col("utt_id")))
    rows = rows.join(resolved.select(*GRAIN, "rec_id", "resolution"), [*GRAIN, "rec_id"], "left")
    reason = (
        F.when(F.col("rec_id").isNull(), LOSSES[0]).when(F.col("resolution").isNull(), LOSSES[1]).when(F.col("resolution") == UNRESOLVED, LOSSES[2])
        .when(strip(F.col("transcript")) == "", LOSSES[3])
    )
    return rows.withColumn("reason", reason).select(*GRAIN, "utt_id", "rec_id", "transcript", "start_sec", "end_sec", "resolution", "reason", F.col("_segmented").alias("segmented"))


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def utterance_counts(rows: DataFrame, utt2dur: DataFrame | None = None) -> DataFrame:
    """Losses, families, distinct speakers and hours by corpus and split, from ``waterfall``."""
    rows = rows.withColumns({"family": recording.family(F.col("rec_id")), "speaker": recording.speaker(F.col("rec_id")), "base": recording.base_id(F.col("rec_id"))})
    if utt2dur is None:
        rows = rows.withColumn("duration", F.lit(None).cast("double"))
    else:
        rows = rows.join(utt2dur.select(*GRAIN, "utt_id", "duration"), [*GRAIN, "utt_id"], "left")
    ok = F.col("reason").isNull()
    is_family = lambda f: ok & (F.col("family") == f)
    seconds = F.when(F.col("segmented"), F.greatest(F.lit(0.0), F.col("end_sec") - F.col("start_sec"))).otherwise(F.coalesce("duration", F.lit(0.0)))
    return rows.groupBy(*GRAIN).agg(
        F.max(F.when(F.col("segmented"), "segmented").otherwise("one-file-per-utterance")).alias("layout"),
        F.count(F.lit(1)).alias("utts_in_text"),
        count_if(ok).alias("verifiable_utts"),
        count_if(ok & (F.col("resolution") == GIVEN)).alias("verifiable_as_given"),
        F.count_distinct(F.when(ok, F.col("base"))).alias("unique_recordings"),
        F.count_distinct(F.when(is_family("monologue"), F.col("speaker"))).alias("unique_monologue_speakers"),
        F.count_distinct(F.when(is_family("stereo_channel"), F.col("speaker"))).alias("unique_stereo_channels"),
        count_if(is_family("vendor") | is_family("unknown")).alias("utts_with_no_speaker_label"),
        *(count_if(is_family(f)).alias(f"fam_{f}") for f in recording.FAMILIES),
        F.round(F.coalesce(F.sum(F.when(ok, seconds)), F.lit(0.0)) / 3600, 2).alias("hours"),
        *(count_if(F.col("reason") == r).alias(f"lost_{r}") for r in LOSSES),
    )


def recording_counts(resolved: DataFrame) -> DataFrame:
    """Resolution and band counts by corpus and split."""
    band = recording.band(F.col("rec_id"))
    return resolved.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("recordings_in_wav_scp"),
        count_if(F.col("resolution") != UNRESOLVED).alias("recordings_resolved"),
        count_if(F.col("resolution") == GIVEN).alias("recordings_path_as_given"),
        count_if(F.col("resolution") == UNRESOLVED).alias("recordings_unresolved"),
        count_if(band == "WB").alias("band_WB"),
        count_if(band == "NB").alias("band_NB"),
        (F.count(F.lit(1)) - F.count_distinct(recording.base_id(F.col("rec_id")))).alias("band_duplicate_recordings"),
    )


def speaker_counts(utt2spk: DataFrame) -> DataFrame:
    return utt2spk.groupBy(*GRAIN).agg(count_if(F.col("utt_id") == F.col("spk_id")).alias("utt2spk_degenerate"), F.count(F.lit(1)).alias("utt2spk_rows"))


def audit(text: DataFrame, segments: DataFrame, resolved: DataFrame, utt2spk: DataFrame, utt2dur: DataFrame | None = None) -> DataFrame:
    """The report: a row of 28 columns for each corpus and split that has transcripts."""
    report = utterance_counts(waterfall(text, segments, resolved), utt2dur)
    sizes = segments.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("segments"))
    for more in (sizes, recording_counts(resolved), speaker_counts(utt2spk)):
        report = report.join(more, GRAIN, "left")
    return report.select(*(F.col(c) if c in ("corpus", "split", "layout", "hours") else F.coalesce(c, F.lit(0)).alias(c) for c in schemas.AUDIT_COLUMNS))


def totals(report: DataFrame) -> DataFrame:
    """Sums over original corpora: derived copies of the same audio don't count, and distinct speakers can't be summed."""
    original = report.where(~F.col("corpus").rlike(recording.DERIVED))
    return original.agg(F.count(F.lit(1)).alias("splits"), F.coalesce(F.sum("verifiable_utts"), F.lit(0)).alias("verifiable_utts"), F.round(F.coalesce(F.sum("hours"), F.lit(0.0)), 2).alias("hours"))


def across_splits(rows: DataFrame) -> DataFrame:
    """Distinct recordings and speakers by corpus and split, by corpus over all its splits (split null), and over everything."""
    ok = rows.where("reason is null").withColumns({"_base": recording.base_id(F.col("rec_id")), "_speaker": recording.speaker(F.col("rec_id"))})
    return ok.rollup(*GRAIN).agg(F.count_distinct("_base").alias("unique_recordings"), F.count_distinct("_speaker").alias("unique_speakers"), F.count(F.lit(1)).alias("utterances"))


def demographics(rows: DataFrame) -> DataFrame:
    """Monologue speakers by city and gender: how many, and their mean age."""
    d = recording.demographics(F.col("rec_id"))
    people = rows.where("reason is null").select(recording.speaker(F.col("rec_id")).alias("speaker"), d.alias("d")).where("d is not null").distinct()
    return people.groupBy(F.col("d.city").alias("city"), F.col("d.gender").alias("gender")).agg(F.count(F.lit(1)).alias("speakers"), F.round(F.avg("d.age"), 4).alias("mean_age"))


def with_fallback_index(index: DataFrame, corpora: DataFrame) -> DataFrame:
    """corpus, basename, path: a derived corpus without audio has the index of the one it is derived from.

    corpora: column corpus; index: corpus, basename, path.
    """
    own = index.select("corpus").distinct().withColumn("_own", F.lit(True))
    original = F.regexp_replace("corpus", recording.DERIVED, "")
    source = corpora.select("corpus").distinct().join(own, "corpus", "left").withColumn("_from", F.when(F.col("_own").isNotNull(), F.col("corpus")).otherwise(original))
    return source.join(index.withColumnRenamed("corpus", "_from"), "_from").select("corpus", "basename", "path")
