"""Streaming evaluation of result files as they arrive. An extension: batches of the same plans, none of their own.

Each micro-batch is evaluated and appended, and edits and lengths are kept by
split; corpus rates are then sums over batches, exactly as over one table. A
batch that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.editdist import char_edits, word_edits
from ..functions.textnorm import words
from ..operators import corpus_eval

INPUT = "utt_id string, split string, reference string, hypothesis string"


def partial_sums(results: DataFrame) -> DataFrame:
    """By split: n, n_skipped and the sums that corpus rates are made of."""
    ref, hyp = F.col("ref_normalized"), F.col("hyp_normalized")
    kept = (ref != "") & (F.col("WER") >= 0) & ~corpus_eval.failed(F.col("hypothesis"))
    total = lambda c, name: F.coalesce(F.sum(F.when(kept, c)), F.lit(0)).cast("long").alias(name)
    return results.groupBy("split").agg(
        total(F.lit(1), "n"), (F.count(F.lit(1)) - F.coalesce(F.sum(kept.cast("long")), F.lit(0))).alias("n_skipped"),
        total(word_edits(ref, hyp), "word_edits"), total(F.size(words(ref)), "ref_words"), total(char_edits(ref, hyp), "char_edits"), total(F.char_length(ref), "ref_chars"),
    )


def corpus_rates(sums: DataFrame) -> DataFrame:
    """split, n, n_skipped, corpus_wer, corpus_cer from sums of any number of batches."""
    rate = lambda e, n: F.coalesce(F.round(F.try_divide(100.0 * F.sum(e), F.sum(n)), 4), F.lit(0.0))
    return sums.groupBy("split").agg(F.sum("n").alias("n"), F.sum("n_skipped").alias("n_skipped"), rate("word_edits", "ref_words").alias("corpus_wer"), rate("char_edits", "ref_chars").alias("corpus_cer"))


def evaluate_arrivals(spark: SparkSession, source: str, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Evaluate the JSON files of a folder; rows go to ``target``/results and sums to ``target``/sums, partitioned by batch."""

    def batch(rows: DataFrame, number: int) -> None:
        results = corpus_eval.evaluate(rows).persist()
        for name, df in (("results", results), ("sums", partial_sums(results))):
            df.write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")
        results.unpersist()

    arrivals = spark.readStream.schema(INPUT).json(source)
    writer = arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
