"""Set similarity of texts and the categories built on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .textnorm import strip, words

AGREE, APART = 0.5, 0.3
FLAGGED = ("AGREE_HYP_ONLY", "DISAGREE_BOTH", "DISAGREE_BOTH_STRONG")


def _jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def char_jaccard(a: Column, b: Column) -> Column:
    """Of the sets of characters without spaces; 1 if both are empty, 0 if one is null."""
    chars = lambda c: F.filter(F.split(F.replace(c, F.lit(" "), F.lit("")), ""), lambda x: x != "")
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(_jaccard(chars(a), chars(b)))


def word_jaccard(a: Column, b: Column) -> Column:
    """Of the sets of words; 1 if both are empty, 0 if one is null."""
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(_jaccard(words(a), words(b)))


def is_blank(c: Column) -> Column:
    """Null, blank, or "nan" in any case."""
    return c.isNull() | strip(c).isin("") | (F.lower(strip(c)) == "nan")


def categorize(third: Column, wr: Column, wh: Column, cr: Column, ch: Column) -> Column:
    """How a third transcript sides; the first rule that holds. wr, wh: word similarity with reference and hypothesis; cr, ch: of characters."""
    rules = [
        (is_blank(third), "WHISPER_SILENT"),
        ((wr >= AGREE) & (wh >= AGREE), "AGREE_BOTH"),
        ((wr >= AGREE) & (wh < APART), "AGREE_REF_ONLY"),
        ((wh >= AGREE) & (wr < APART), "AGREE_HYP_ONLY"),
        ((cr < APART) & (ch < APART), "DISAGREE_BOTH_STRONG"),
        ((wr < APART) & (wh < APART), "DISAGREE_BOTH"),
    ]
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for holds, name in rules[1:]:
        out = out.when(holds, F.lit(name))
    return out.otherwise(F.lit("PARTIAL_MATCH"))
