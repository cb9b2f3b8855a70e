"""Word and character error rates.

Word edits are native: the words of a pair are numbered by a dictionary of
their own, numbers become characters, and ``levenshtein`` does the rest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .textnorm import words

#: More distinct words than this in one pair of texts is an error rather than a wrong result; each has a character of its own from FIRST on.
DICTIONARY, FIRST = 40_000, 0x3400


def _character(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n + FIRST), 4, "0")), "UTF-16BE")


def word_edits(ref: Column, hyp: Column) -> Column:
    """Least number of word insertions, deletions and substitutions."""

    def distance(s: Column) -> Column:
        coded = lambda ws: F.array_join(F.transform(ws, lambda w: _character(F.array_position(s["known"], w))), "")
        too_many = F.raise_error(F.lit("too many distinct words in a pair")).cast("int")
        return F.when(F.size(s["known"]) > DICTIONARY, too_many).otherwise(F.levenshtein(coded(s["r"]), coded(s["h"])))

    pair = F.struct(words(ref).alias("r"), words(hyp).alias("h"))
    return let(pair, lambda p: let(F.struct(p["r"].alias("r"), p["h"].alias("h"), F.array_distinct(F.concat(p["r"], p["h"])).alias("known")), distance))


def char_edits(ref: Column, hyp: Column) -> Column:
    return F.levenshtein(ref, hyp)


def edits(ref: Column, hyp: Column) -> Column:
    """struct(words, chars): edits between two normalised texts. The costly part of error rates, so make it a column and use it again."""
    return F.when((ref == "") | (hyp == ""), F.struct(F.size(words(F.concat(ref, hyp))).alias("words"), F.char_length(F.concat(ref, hyp)).alias("chars"))).otherwise(
        F.struct(word_edits(ref, hyp).alias("words"), char_edits(ref, hyp).alias("chars"))
    )


def error_rates(ref: Column, hyp: Column, found: Column | None = None) -> Column:
    """struct(WER, CER) in percent of normalised texts, rounded to 4: 0 if both are empty, -1 if the reference is, 100 if the hypothesis is. found: their ``edits``."""
    r, h = F.coalesce(ref, F.lit("")), F.coalesce(hyp, F.lit(""))
    found = edits(r, h) if found is None else found
    rate = lambda n, of: F.when(of > 0, F.round(100.0 * n / of, 4)).otherwise(F.when(h == "", 0.0).otherwise(-1.0))
    return F.struct(rate(found["words"], F.size(words(r))).alias("WER"), rate(found["chars"], F.char_length(r)).alias("CER"))
