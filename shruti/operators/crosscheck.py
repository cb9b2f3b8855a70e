"""Cross-check of reference and hypothesis against a third transcript."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity

AUDIO_ERROR, THIRD_ERROR = "AUDIO_ERROR", "WHISPER_ERROR"


def crosscheck(rows: DataFrame) -> DataFrame:
    """``rows`` (reference, hypothesis, whisper, and audio_error, whisper_error where known) with four similarities and a category.

    Similarities are rounded to 4 after the category is chosen; an error row has zeros.
    """
    third, ref, hyp = F.coalesce(F.col("whisper"), F.lit("")), F.col("reference"), F.col("hypothesis")
    exact = {"_wr": similarity.word_jaccard(third, ref), "_wh": similarity.word_jaccard(third, hyp), "_cr": similarity.char_jaccard(third, ref), "_ch": similarity.char_jaccard(third, hyp)}
    out = rows.withColumns(exact)
    audio, other = (F.col(c).isNotNull() if c in rows.columns else F.lit(False) for c in ("audio_error", "whisper_error"))
    category = similarity.categorize(F.col("whisper"), F.col("_wr"), F.col("_wh"), F.col("_cr"), F.col("_ch"))
    shown = lambda c: F.when(audio | other, 0.0).otherwise(F.round(c, 4))
    return out.withColumns({
        "wjac_whisper_ref": shown("_wr"), "wjac_whisper_hyp": shown("_wh"), "cjac_whisper_ref": shown("_cr"), "cjac_whisper_hyp": shown("_ch"),
        "category": F.when(audio, AUDIO_ERROR).when(other, THIRD_ERROR).otherwise(category),
    }).drop(*exact)


def flagged(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("category").isin(*similarity.FLAGGED))


def histogram(checked: DataFrame) -> DataFrame:
    """category, n and percent, the most frequent first."""
    counts = checked.groupBy("category").agg(F.count(F.lit(1)).alias("n"))  # a row for each category
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(100.0 * F.col("n") / total, 4)).orderBy(F.desc("n"), "category")
