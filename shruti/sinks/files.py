"""Output files, each a folder of parts; contents are as Python's csv and json write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_ids(df: DataFrame, path: str, column: str = "utt_id") -> None:
    """One id per line, sorted; no ids at all are one blank line."""
    ids = df.select(F.col(column).cast("string").alias("value"))
    blank = df.sparkSession.createDataFrame([("",)], "value string")
    (blank if ids.isEmpty() else ids.orderBy("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, sep: str = ",", by: list[str] | None = None) -> None:
    """Header, minimal quotes, quotes doubled; an empty table gives the header alone. by: partition columns."""
    columns = columns or df.columns
    flat = df.select(*(F.col(c).cast("string").alias(c) if dict(df.dtypes)[c].startswith(("array", "struct", "map")) else F.col(c) for c in columns))
    writer = flat.write.mode("overwrite").options(header=True, sep=sep, quote='"', escape='"', emptyValue="", nullValue="")
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_accepted(report: DataFrame, folder: str) -> None:
    """Accepted and rejected ids, and the report as TSV and CSV."""
    report = report.orderBy("utt_id")
    write_ids(report.where(F.col("pass")), f"{folder}/accepted_utts.txt")
    write_ids(report.where(~F.col("pass")), f"{folder}/rejected_utts.txt")
    write_csv(report, f"{folder}/quality_report.tsv", sep="\t")
    write_csv(report, f"{folder}/quality_report.csv")


def manifest_line(audio_filepath: Column, text: Column, utt_id: Column, duration: Column, offset: Column) -> Column:
    """A JSON object; the offset is left out where it is null."""
    return F.to_json(F.struct(audio_filepath.alias("audio_filepath"), text.alias("text"), utt_id.alias("utt_id"), F.round(duration, 3).alias("duration"), offset.alias("offset")))


def write_manifest(rows: DataFrame, path: str) -> None:
    """rows: audio_filepath, text, utt_id, duration, offset."""
    rows.select(manifest_line(*(F.col(c) for c in ("audio_filepath", "text", "utt_id", "duration", "offset"))).alias("value")).write.mode("overwrite").text(path)


def summary_line(split: Column, n: Column, corpus_wer: Column, corpus_cer: Column, avg_wer: Column) -> Column:
    """One split's line of the fixed-width summary."""
    percent = lambda c, width: F.lpad(F.format_string("%.2f%%", c.cast("double")), width, " ")
    return F.concat_ws(" ", F.rpad(split, 8, " "), F.lpad(F.format_number(n, 0), 12, " "), percent(corpus_wer, 12), percent(corpus_cer, 12), percent(avg_wer, 13))


def write_summary(summary: DataFrame, path: str, decoder: str, language: str) -> None:
    """Heading and a line for each split. A summary has a row per split, so one task writes it."""
    spark = summary.sparkSession
    cells = [("Split", -8), ("Utterances", 12), ("Corpus WER", 12), ("Corpus CER", 12), ("Avg Utt WER", 13)]
    head = [f"Decoder: {decoder.upper()} | Language: {language}", "", " ".join(f"{c:<8}" if w < 0 else f"{c:>{w}}" for c, w in cells), " ".join("─" * abs(w) for _, w in cells)]
    top = spark.createDataFrame(list(enumerate(head)), "i int, value string")
    body = summary.select(F.lit(len(head)).alias("i"), "split", summary_line(*(F.col(c) for c in ("split", "n", "corpus_wer", "corpus_cer", "avg_wer"))).alias("value"))
    top.withColumn("split", F.lit("")).unionByName(body).coalesce(1).sortWithinPartitions("i", "split").select("value").write.mode("overwrite").text(path)


def write_wavs(converted: DataFrame, out_column: str) -> DataFrame:
    """Write each row's wav bytes to its own path; returns path, bytes written and status (converted, skipped or error; an error writes nothing).

    Paths must be on a store that all executors mount; a file appears whole or not at all, so a task can be run again.
    """
    import os
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, wav, status in zip(batch["out"], batch["wav"], batch["status"]):
                if wav is None:
                    rows.append((path, 0, "error"))
                    continue
                os.makedirs(os.path.dirname(path), exist_ok=True)
                part = f"{path}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(wav)
                os.replace(part, path)
                rows.append((path, len(wav), status))
            yield pd.DataFrame(rows, columns=["path", "bytes", "status"])

    return converted.select(F.col(out_column).alias("out"), "wav", "status").mapInPandas(run, "path string, bytes long, status string")
