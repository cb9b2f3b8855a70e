"""Text normalisation as Column expressions.

Normalised text has letters, digits, underscores and single spaces: it is
composed (NFC), three marks and all else go (combining marks too), white space
collapses, and letters are lower-cased.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Python's white space, as ranges for a character class; and marks that are deleted first.
PYWS = r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}-\x{2029}\x{202F}\x{205F}\x{3000}"
DELETED = r"[\x{964}\x{965}\x{C3D}]"


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """The one step that Spark has no function for; texts already composed come back as they are."""
    return texts.map(lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def strip(c: Column) -> Column:
    """Without white space at the ends, as Python's ``strip``."""
    return F.regexp_replace(c, f"^[{PYWS}]+|[{PYWS}]+$", "")


def words(c: Column) -> Column:
    """Parts between white space, as Python's ``split``; none for blank text."""
    return F.filter(F.split(c, f"[{PYWS}]+"), lambda w: w != "")


def normalize(c: Column) -> Column:
    kept = F.regexp_replace(F.regexp_replace(strip(nfc(c)), DELETED, ""), rf"[^\p{{L}}\p{{N}}_{PYWS}]", "")
    return F.lower(strip(F.regexp_replace(kept, f"[{PYWS}]+", " ")))
