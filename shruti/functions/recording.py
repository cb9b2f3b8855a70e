"""What recording ids and audio entries say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .textnorm import PYWS, strip, words

#: Fixed patterns of recording ids, tried in this order after the band suffix is gone.
BAND = "_(WB|NB)$"
MONOLOGUE = r"^(\d+)_([A-Za-z]+)_([A-Z]{1,2})_(\d+)_"
STEREO = r"^([a-z]{2})_IN_(\d+)_(\d+)_(Left|Right)$"
VENDOR = r"^([a-z]{2})_([A-Za-z0-9]+)_([A-Z]+\d*)_r(\d+)_[sS](\d+)$"
FAMILIES = ("monologue", "stereo_channel", "vendor", "unknown")
DERIVED = "_(cleaned|final)$"


def base_id(rec: Column) -> Column:
    return F.regexp_replace(rec, BAND, "")


def band(rec: Column) -> Column:
    """WB, NB or null."""
    return F.nullif(F.regexp_extract(rec, BAND, 1), F.lit(""))


def family(rec: Column) -> Column:
    base = base_id(rec)
    return F.when(base.rlike(MONOLOGUE), "monologue").when(base.rlike(STEREO), "stereo_channel").when(base.rlike(VENDOR), "vendor").otherwise("unknown")


def speaker(rec: Column) -> Column:
    """The four parts of a monologue id, a stereo id itself, else null."""
    base = base_id(rec)
    parts = F.concat_ws("_", *(F.regexp_extract(base, MONOLOGUE, i) for i in range(1, 5)))
    return F.when(base.rlike(MONOLOGUE), parts).when(base.rlike(STEREO), base)


def classify(rec: Column) -> Column:
    """struct(family, speaker, base)."""
    return F.struct(family(rec).alias("family"), speaker(rec).alias("speaker"), base_id(rec).alias("base"))


def demographics(rec: Column) -> Column:
    """struct(city, gender, age) of a monologue id, else null."""
    base = base_id(rec)
    part = lambda i: F.regexp_extract(base, MONOLOGUE, i)
    return F.when(base.rlike(MONOLOGUE), F.struct(part(2).alias("city"), part(3).alias("gender"), part(4).cast("int").alias("age")))


def is_pipe(entry: Column) -> Column:
    """A shell command instead of a path. Such strings are never executed."""
    return F.coalesce(strip(entry).endswith("|"), F.lit(False))


def first_token(entry: Column) -> Column:
    return F.coalesce(F.try_element_at(words(entry), F.lit(1)), F.lit(""))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def file_safe(utt_id: Column) -> Column:
    return F.translate(utt_id, "/", "_")


def audio_label(path: Column, start: Column, end: Column) -> Column:
    return F.when(start.isNull(), path).otherwise(F.format_string("%s  [%.3f-%.3fs]", path, start, end))


__all__ = ["PYWS", "audio_label", "band", "base_id", "basename", "classify", "demographics", "family", "file_safe", "first_token", "is_pipe", "speaker", "stem"]
