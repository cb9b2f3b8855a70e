"""Audio trees and WAV files: listings, header probes, decoding, conversion.

Listings read paths and lengths only; the content column is never asked for.
Headers and samples are read in Arrow batches, one file at a time.
"""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import recording, signal

#: Where a corpus keeps its audio, in order of preference, and what counts as audio where.
SUBDIRS = ("Audio", "audio", "audio_16k", "wav")
#: Longer than any path: what is left of a string.
MAX_PATH = 1 << 20
INDEXED = r"(?i)\.(wav|flac)$"
SCANNED = r"\.(wav|flac|mp3|ogg|m4a|opus|aac)$"


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path (as listed) and length of all files below the root whose name fits."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return found.where(F.col("path").rlike(pattern))


def scan(spark: SparkSession, root: str) -> DataFrame:
    """All audio files by path."""
    return files(spark, root, SCANNED).orderBy("path")


def index(listing: DataFrame, root: str) -> DataFrame:
    """basename and path, one for each basename: of the preferred subfolder, then the first by path."""
    inside = F.regexp_replace("path", r"^[a-z]+:/+", "/")
    sub = F.regexp_extract(F.substring(inside, len(root.rstrip("/")) + 2, MAX_PATH), "^[^/]+", 0)
    rank = F.array_position(F.array(*map(F.lit, SUBDIRS)), sub)
    ranked = listing.where(F.col("path").rlike(INDEXED)).withColumn("_rank", rank).where("_rank > 0").withColumn("basename", recording.basename(F.col("path")))
    return ranked.groupBy("basename").agg(F.min(F.struct("_rank", "path")).alias("_m")).select("basename", F.col("_m.path").alias("path"))


def folder_pairs(audio: DataFrame, transcripts: DataFrame) -> DataFrame:
    """stem, audio_path, transcript_path of what either side has (a full join, so that both leftovers are seen in one pass)."""
    a = audio.select(recording.stem(F.col("path")).alias("stem"), F.col("path").alias("audio_path"))
    t = transcripts.select(recording.stem(F.col("path")).alias("stem"), F.col("path").alias("transcript_path"))
    return a.join(t, "stem", "full")


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """stem and stripped text of each file of a folder."""
    from ..functions.textnorm import strip

    read = spark.read.text(f"{folder}/*.txt", wholetext=True)
    return read.select(recording.stem(F.col("_metadata.file_path")).alias("stem"), strip(F.col("value")).alias("transcript"))


def header(data: bytes) -> tuple:
    """Rate, channels, frames, bytes a sample of a WAV file; an error's text instead if there is one."""
    try:
        with wave.open(io.BytesIO(data)) as f:
            return f.getframerate(), f.getnchannels(), f.getnframes(), f.getsampwidth(), None
    except (wave.Error, EOFError, struct.error, RuntimeError) as e:
        return None, None, None, None, str(e) or type(e).__name__


def decode(data, cut=None) -> tuple[np.ndarray, int]:
    """Samples (frames, channels) between -1 and 1, and the rate, of a PCM WAV file, given as bytes or as an open file.

    cut: first frame and number of frames for a rate; only these are read.
    """
    with wave.open(data if hasattr(data, "read") else io.BytesIO(data)) as f:
        width, channels, rate, total = f.getsampwidth(), f.getnchannels(), f.getframerate(), f.getnframes()
        first, n = (0, total) if cut is None else cut(rate)
        first = min(max(first, 0), total)
        f.setpos(first)
        raw = f.readframes(min(max(n, 0), total - first))
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels), rate


def encode(wav: np.ndarray, rate: int = signal.RATE) -> bytes:
    """A 16-bit mono PCM WAV file."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.clip(np.rint(np.asarray(wav, np.float64) * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


@F.pandas_udf(schemas.HEADER)
def probe(content: pd.Series) -> pd.DataFrame:
    """Header of each file's content."""
    return pd.DataFrame([header(c or b"") for c in content], columns=["sample_rate", "channels", "frames", "sample_width", "error"])


def needs_conversion(sample_rate, channels):
    """Column: not 16 kHz mono, or unreadable."""
    return F.coalesce((sample_rate != signal.RATE) | (channels != 1), F.lit(True))


CONVERTED = "path string, status string, wav binary, seconds double"


def convert(found: DataFrame) -> DataFrame:
    """path, status (converted, skipped or an error's text), wav (16 kHz mono file) and seconds of each row of path, content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    x, rate = decode(content)
                    same = rate == signal.RATE and x.shape[1] == 1
                    wav = signal.resample(x.mean(1) if len(x) else x[:, 0], rate)
                    row = (path, "skipped" if same else "converted", content if same else encode(wav), len(wav) / signal.RATE)
                except (wave.Error, EOFError, struct.error, KeyError, ValueError, TypeError) as e:
                    row = (path, f"error: {e or type(e).__name__}", None, None)
                yield pd.DataFrame([row], columns=["path", "status", "wav", "seconds"])

    return found.select("path", "content").mapInPandas(run, CONVERTED)


def output_path(path, source: str, target: str | None):
    """Column: the same place below another root, ending in .wav; without one the path itself."""
    if target is None:
        return path
    inside = F.substring(path, len(source.rstrip("/")) + 2, MAX_PATH)
    return F.concat(F.lit(target.rstrip("/") + "/"), F.regexp_replace(inside, r"\.[^./]*$", ".wav"))


def collisions(paths: DataFrame, out: str) -> DataFrame:
    """Output paths that several inputs would go to."""
    return paths.groupBy(out).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def clips(utterances: DataFrame, contents: DataFrame, rounding: str = "offset_first") -> DataFrame:
    """utt_id, wav, seconds, error: each utterance's mono samples at 16 kHz in the unit range.

    utterances: utt_id, path, start, end (null: whole); contents: path, content.
    The join brings a file's content to its utterances; each is cut before resampling.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for utt, start, end, content in zip(batch["utt_id"], batch["start"], batch["end"], batch["content"]):
                try:
                    x, rate = decode(content)
                    if start == start and start is not None:
                        off, n = frames_of(start, end, rate, rounding)
                        x = x[off : off + max(n, 0)]
                    wav = signal.resample(x.mean(1) if len(x) else np.zeros(0), rate)
                    row = (utt, wav, len(wav) / signal.RATE, None)
                except (wave.Error, EOFError, struct.error, KeyError, ValueError, TypeError) as e:
                    row = (utt, None, 0.0, str(e) or type(e).__name__)
                yield pd.DataFrame([row], columns=["utt_id", "wav", "seconds", "error"])

    joined = utterances.join(contents, "path", "left").select("utt_id", "start", "end", "content")
    return joined.mapInPandas(run, "utt_id string, wav array<float>, seconds double, error string")


def frames_of(start: float, end: float, rate: int, rounding: str) -> tuple[int, int]:
    """First frame and number of frames of a time range; the roundings are those of ``signal.segment``."""
    off, until = int(start * rate), int(end * rate)
    return off, max(until - off, 1) if rounding == "offset_first" else int(end * rate - off) if rounding == "joint" else until - off


def opened(path: str):
    """A file of whatever store the path names, which executors can read."""
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def cuts(utterances: DataFrame, rounding: str = "offset_first") -> DataFrame:
    """``utterances`` (path, start, end, and any others) with wav, seconds and audio_error.

    Each utterance's own frames are read from its file, so neither files nor
    rows are shuffled and a recording is never read whole for a part of it.
    """
    has = utterances.schema
    schema = T.StructType([*has.fields, *T._parse_datatype_string("wav array<float>, seconds double, audio_error string").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.iloc[i : i + 1].copy()
                path, start, end = (row[c].iloc[0] for c in ("path", "start", "end"))
                try:
                    if path is None or path.rstrip().endswith("|"):
                        raise ValueError(f"no file: {path}")
                    with opened(path.strip()) as f:
                        x, rate = decode(f, None if pd.isna(start) else lambda r: frames_of(start, end, r, rounding))
                    wav = signal.resample(x.mean(1) if len(x) else np.zeros(0), rate)
                    found = (wav, len(wav) / signal.RATE, None)
                except (wave.Error, EOFError, struct.error, KeyError, ValueError, TypeError, OSError) as e:
                    found = (None, 0.0 if pd.isna(start) else float(end - start), str(e) or type(e).__name__)
                row["wav"], row["seconds"], row["audio_error"] = [found[0]], [found[1]], [found[2]]
                yield row

    return utterances.mapInPandas(run, schema)


def lengths(paths: DataFrame) -> DataFrame:
    """path and seconds of each row of path, by the header alone; null where it can't be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seconds = []
            for path in batch["path"]:
                try:
                    with opened(path) as f, wave.open(f) as w:
                        seconds.append(w.getnframes() / w.getframerate())
                except (wave.Error, EOFError, struct.error, ValueError, TypeError, OSError, ZeroDivisionError):
                    seconds.append(None)
            yield pd.DataFrame({"path": batch["path"], "seconds": pd.Series(seconds, dtype="float64")})

    return paths.select("path").mapInPandas(run, "path string, seconds double")


def listed(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """path and length of a folder's files that end so, one level only. Empty files, which Spark's readers leave out, are among them."""
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(folder)
    found = [f for f in store.get_file_info(fs.FileSelector(inside)) if f.is_file and f.base_name.endswith(suffix) and not f.base_name.startswith((".", "_"))]
    empty = spark.createDataFrame([(f"{folder}/{f.base_name}", 0) for f in found if not f.size], "path string, length long")
    if not any(f.size for f in found):
        return empty
    return spark.read.format("binaryFile").load(f"{folder}/*{suffix}").select("path", "length").unionByName(empty)


def first_files(listing: DataFrame, n: int = 10) -> DataFrame:
    """The first files by path; the sample that a dry run reports on."""
    return listing.orderBy("path").limit(n)


def chunk_of(df: DataFrame, chunks: int, *order: str) -> DataFrame:
    """Contiguous chunks of equal size, the last with the remainder; never more chunks than rows.

    Ranks come from counts per range partition, so rows are sorted but never in one task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number, so that numbers of partitions are the same in both branches
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    by_part = Window.orderBy("_part")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    counts = counts.withColumn("_total", F.sum("_n").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    first = F.col("_row") - F.shiftleft(F.col("_part").cast("long"), 33)
    out = ranged.join(F.broadcast(counts), "_part").withColumn("_pos", F.col("_before") + first)
    k = F.least(F.lit(chunks), F.col("_total"))
    size = F.floor(F.col("_total") / k)
    return out.withColumn("chunk", F.least(F.floor(F.col("_pos") / size), k - 1).cast("int")).drop("_part", "_row", "_n", "_before", "_total", "_pos")
