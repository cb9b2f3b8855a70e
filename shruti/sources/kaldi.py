"""Kaldi-style text files as DataFrames.

A file is cut into numbered lines on the JVM. Of a repeated key the last value
counts, at the place of the first line; grouped maxima do it, so no key's lines
ever meet unaggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.textnorm import PYWS, strip, words

LINES = "source string, line_no int, line string"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at the path, in whatever store it is."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where))


def lines(spark: SparkSession, path: str | list[str], optional: bool = False) -> DataFrame:
    """source, line_no, line of every line; nothing for a missing file if it is optional. Broken UTF-8 is replaced."""
    paths = [path] if isinstance(path, str) else path
    if optional:
        paths = [p for p in paths if exists(spark, p)]
        if not paths:
            return spark.createDataFrame([], LINES)
    read = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("source"), F.make_valid_utf8("value").alias("value"))
    return read.select("source", F.posexplode(F.split("value", "\r\n|\r|\n")).alias("line_no", "line"))


def numbered(df: DataFrame, order: Column, line: Column, source: Column | None = None) -> DataFrame:
    """Lines from any table."""
    return df.select((F.lit("") if source is None else source).alias("source"), order.alias("line_no"), line.alias("line"))


def last_wins(df: DataFrame, key: str, *values: str) -> DataFrame:
    """source, key, values of each key's last line, and line_no of its first."""
    last = F.max_by(F.struct(*values), "line_no")
    return df.groupBy("source", key).agg(F.min("line_no").alias("line_no"), last.alias("_v")).select("source", key, *(F.col(f"_v.{v}").alias(v) for v in values), "line_no")


def two_column(read: DataFrame, key: str, value: str, need_value: bool = False) -> DataFrame:
    """Key and remainder of each line that isn't blank; without a remainder it is empty, or the line is dropped."""
    line = strip(F.col("line"))
    head = F.regexp_extract(line, f"^[^{PYWS}]+", 0)
    split = read.where(line != "").select("source", "line_no", head.alias(key), strip(F.substring(line, F.char_length(head) + 1, F.char_length(line))).alias(value))
    return last_wins(split.where(F.col(value) != "") if need_value else split, key, value)


def text(read: DataFrame) -> DataFrame:
    return two_column(read, "utt_id", "transcript")


def wav_scp(read: DataFrame, need_value: bool = True) -> DataFrame:
    return two_column(read, "rec_id", "audio_source", need_value)


def utt2spk(read: DataFrame) -> DataFrame:
    """The second field of each line that has one; more fields are ignored."""
    parts = words(F.col("line"))
    return last_wins(read.where(F.size(parts) >= 2).select("source", "line_no", parts[0].alias("utt_id"), parts[1].alias("spk_id")), "utt_id", "spk_id")


def segments(read: DataFrame) -> DataFrame:
    """Lines of exactly four fields; a time that is no number is an error."""
    parts = words(F.col("line"))
    four = read.where(F.size(parts) == 4).select("source", "line_no", parts[0].alias("utt_id"), parts[1].alias("rec_id"), parts[2].cast("double").alias("start_sec"), parts[3].cast("double").alias("end_sec"))
    return last_wins(four, "utt_id", "rec_id", "start_sec", "end_sec")


def malformed_segments(read: DataFrame) -> DataFrame:
    """Lines that ``segments`` leaves out, but for blank ones."""
    parts = words(F.col("line"))
    return read.where((F.size(parts) != 4) & (F.size(parts) > 0))


def utt2dur(read: DataFrame) -> DataFrame:
    """Durations; values that are no numbers are dropped. Of a repeated key the last line counts, number or not."""
    pairs = two_column(read, "utt_id", "duration")
    return pairs.withColumn("duration", F.col("duration").try_cast("double")).where("duration is not null")


def by_layout(segs: DataFrame | None, mode: str = "exists") -> bool:
    """Whether a split is segmented. mode: exists (there is a file) or parsed (it has a valid line)."""
    if segs is None:
        return False
    return True if mode == "exists" else bool(segs.limit(1).count())
