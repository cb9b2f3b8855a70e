"""Recognition quality: per-utterance and corpus error rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.editdist import edits, error_rates
from ..functions.textnorm import normalize, words

AUDIO_FAILED, INFERENCE_FAILED = "[AUDIO_FAILED]", "[INFERENCE_FAILED]"


def evaluate(rows: DataFrame, reference: str = "reference", hypothesis: str = "hypothesis") -> DataFrame:
    """``rows`` with ref_normalized, hyp_normalized, edits (of words and chars), WER and CER. A missing hypothesis counts as the failure marker."""
    hyp = F.coalesce(F.col(hypothesis), F.lit(AUDIO_FAILED))
    rows = rows.withColumns({"ref_normalized": normalize(F.coalesce(F.col(reference), F.lit(""))), "hyp_normalized": normalize(hyp)})
    ref, hyp = F.col("ref_normalized"), F.col("hyp_normalized")
    rows = rows.withColumn("edits", edits(ref, hyp))
    rates = error_rates(ref, hyp, F.col("edits"))
    return rows.withColumns({"WER": rates["WER"], "CER": rates["CER"]})


def failed(hypothesis: Column) -> Column:
    return F.coalesce(hypothesis, F.lit(AUDIO_FAILED)).rlike(r"\[(AUDIO|INFERENCE)_FAILED\]")


def summarize(results: DataFrame, *by: str, compat_failed_rows: bool = False) -> DataFrame:
    """n, n_skipped, mean and corpus error rates of each group; corpus rates are total edits over total length.

    Rows with an empty reference are skipped, and failed ones. compat_failed_rows:
    look for the markers in the normalised hypothesis, where they can't be, so
    that failed rows count as errors.
    """
    lost = failed(F.col("hyp_normalized") if compat_failed_rows else F.col("hypothesis"))
    kept = (F.col("ref_normalized") != "") & (F.col("WER") >= 0) & ~lost
    n = F.coalesce(F.sum(kept.cast("long")), F.lit(0))
    ref, hyp = F.col("ref_normalized"), F.col("hyp_normalized")
    found = F.col("edits") if "edits" in results.columns else edits(ref, hyp)
    when = lambda c: F.when(F.col("_kept"), c)
    rows = results.withColumn("_kept", kept).withColumns({
        "_words": when(F.size(words(ref))), "_chars": when(F.char_length(ref)), "_word_edits": when(found["words"]), "_char_edits": when(found["chars"]),
    })
    mean = lambda c: F.coalesce(F.round(F.avg(when(F.col(c))), 4), F.lit(0.0))
    rate = lambda edits, length: F.coalesce(F.round(F.try_divide(100.0 * F.sum(edits), F.sum(length)), 4), F.lit(0.0))
    return rows.groupBy(*by).agg(
        n.alias("n"), (F.count(F.lit(1)) - n).alias("n_skipped"), mean("WER").alias("avg_wer"), mean("CER").alias("avg_cer"),
        rate("_word_edits", "_words").alias("corpus_wer"), rate("_char_edits", "_chars").alias("corpus_cer"),
    )
