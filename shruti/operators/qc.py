"""Transcript and audio agreement: CTC scores, the pass rule, the report and its summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ctc, recording, signal

SCORE_THRESHOLD = -2.0


def score(rows: DataFrame, n_classes: int, blank: int, seconds: str = "audio_duration", with_path: bool = True) -> DataFrame:
    """``rows`` (frames of log-probabilities, target, seconds, and wav where there is one) with all scores and an error text.

    Failed rows have -99 for scores; their noise estimate stays. with_path: token
    scores and times too, which need the frame path.
    """
    frames, target = F.col("frames"), F.col("target")
    wav = F.col("wav") if "wav" in rows.columns else None
    out = rows.withColumn("_v3", signal.level_statistic(wav) if wav is not None else F.lit(None).cast("double"))
    out = out.withColumns({
        "snr": signal.wada_snr(wav, statistic=F.col("_v3")) if wav is not None else F.lit(float("nan")),
        "audio_frames": F.size(frames), "target_length": F.size(target), "error": ctc.target_error(target, F.lit(n_classes), F.size(frames), blank),
    }).drop("_v3")
    ok = F.col("error") == ""
    out = out.withColumns({"_forced": F.when(ok, ctc.forced_logprob(frames, target, blank)), "_greedy": F.when(ok, ctc.greedy_logprob(frames)), "pred_ids": ctc.greedy(frames, blank)})
    fail = F.lit(ctc.FAIL_SCORE)
    gap = F.col("_forced") - F.col("_greedy")
    out = out.withColumns({
        "forced_logprob": F.coalesce("_forced", fail), "greedy_logprob": F.coalesce("_greedy", fail), "score": F.coalesce(F.try_divide(gap, F.col("target_length")), fail),
        "lr_per_frame": F.coalesce(F.try_divide(gap, F.col("audio_frames")), fail),
    }).drop("_forced", "_greedy")
    if not with_path:
        return out
    shift = F.try_divide(F.col(seconds), F.col("audio_frames"))
    out = out.withColumn("_a", ctc.align_udf(blank)(F.when(ok, frames), F.when(ok, target)))
    out = out.withColumn("_spans", ctc.spans(F.col("_a.path"), blank))
    out = out.withColumn("_token_scores", ctc.token_scores(F.col("_spans"), F.col("_a.scores")))
    first, last = F.try_element_at("_spans", F.lit(1)), F.try_element_at("_spans", F.lit(-1))
    failed = lambda c: F.when(ok, c).otherwise(fail)
    return out.withColumns({
        "mean_token_score": failed(ctc.mean_of(F.col("_token_scores"))), "min_token_score": failed(ctc.min_of(F.col("_token_scores"))),
        "start_time": F.coalesce(first["s"] * shift, F.lit(0.0)), "end_time": F.coalesce(last["e"] * shift, F.lit(0.0)),
        "token_boundaries": ctc.boundaries(F.col("_spans"), shift),
    }).drop("_a", "_spans", "_token_scores")


def passes(threshold: float = SCORE_THRESHOLD, min_token: float | None = None) -> Column:
    rule = (F.col("error") == "") & (F.col("score") >= threshold)
    return rule if min_token is None else rule & (F.col("min_token_score") >= min_token)


def report(rows: DataFrame, vocabulary: list[str] | None = None, threshold: float = SCORE_THRESHOLD, min_token: float | None = None) -> DataFrame:
    """The report's columns from scored rows that have utt_id, text, path, start, end."""
    from .. import schemas

    label = recording.audio_label(F.coalesce(F.col("path"), F.lit("")), F.col("start"), F.col("end"))
    out = rows.withColumns({"pass": passes(threshold, min_token), "ref_tokens": ctc.ids_to_text(F.col("target"), vocabulary), "pred_tokens": ctc.ids_to_text(F.col("pred_ids"), vocabulary), "audio_path": label})
    return out.select(*schemas.QC_COLUMNS)


def distribution(c: Column, name: str) -> list[Column]:
    """Mean, median, 10th and 90th percentile, exact and interpolated."""
    q = F.percentile(c, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    parts = {"mean": F.avg(c), "p10": F.get(q, F.lit(0)), "median": F.get(q, F.lit(1)), "p90": F.get(q, F.lit(2))}
    return [F.round(v, 4).alias(f"{name}_{k}") for k, v in parts.items()]


def summary(scored: DataFrame, compat_sentinel: bool = False) -> DataFrame:
    """Totals, shares, and distributions of scores (of rows without error) and noise estimates (finite ones).

    compat_sentinel: leave out scores of -90 and less instead of rows with an error.
    """
    good = F.col("score") > -90 if compat_sentinel else F.col("error") == ""
    finite = ~F.isnan("snr") & (F.abs("snr") != float("inf"))
    n, accepted = F.count(F.lit(1)), F.coalesce(F.sum(F.col("pass").cast("long")), F.lit(0))
    share = lambda c: F.round(F.coalesce(F.try_divide(100.0 * c, n), F.lit(0.0)), 4)
    return scored.agg(
        n.alias("total"), accepted.alias("accepted"), (n - accepted).alias("rejected"), share(accepted).alias("accepted_percent"), share(n - accepted).alias("rejected_percent"),
        *distribution(F.when(good, F.col("score")), "score"), *distribution(F.when(finite, F.col("snr")), "snr"),
    )
