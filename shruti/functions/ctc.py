"""CTC scoring over arrays of frames: log-softmax, slices, greedy and forced paths, spans and scores.

Scores are Column expressions; the frame path of an alignment, which needs
back pointers, is an Arrow UDF over the same recurrence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

NEVER = -1e30
FAIL_SCORE = -99.0


@dataclass(frozen=True)
class Slice:
    """A language's block of a joint output, and the blank's place."""

    offset: int
    width: int
    blank: int


def language_slice(n_classes: int, languages: list[str] | None = None, language: str | None = None, offsets: dict[str, int] | None = None, width: int | None = None, blank: int | None = None) -> Slice:
    """Where a language's tokens are: an explicit offset, else its place among equal blocks. What can't be right is an error.

    n_classes: outputs, the blank among them; the blank is the last unless given.
    """
    blank = n_classes - 1 if blank is None else blank
    if not 0 <= blank < n_classes:
        raise ValueError(f"blank {blank} is not one of {n_classes} classes")
    if language is None:
        return Slice(0, n_classes - 1, blank)
    if offsets and language in offsets:
        offset, width = offsets[language], 256 if width is None else width
    elif languages and language in languages:
        if (n_classes - 1) % len(languages):
            raise ValueError(f"{n_classes - 1} tokens don't divide among {len(languages)} languages")
        width = (n_classes - 1) // len(languages)
        offset = languages.index(language) * width
    else:
        raise ValueError(f"no block is known for language {language!r}")
    if offset + width > n_classes - 1:
        raise ValueError(f"block {offset} to {offset + width} overruns the {n_classes - 1} tokens")
    return Slice(offset, width, blank)


def frame_shift(stride: float = 0.01, subsampling: int = 4, probe_frames: int | None = None, rate: int = 16_000) -> float:
    """Seconds a frame: stride (in samples if over 1) times subsampling, unless a probe of one second says more than a quarter otherwise."""
    shift = (stride / rate if stride > 1 else stride) * subsampling
    if probe_frames and abs(1 / probe_frames - shift) / shift > 0.25:
        return 1 / probe_frames
    return shift


def log_sum_exp(frame: Column) -> Column:
    return let(F.array_max(frame), lambda top: top + F.ln(F.aggregate(frame, F.lit(0.0), lambda s, y: s + F.exp(y - top))))


def log_softmax(frame: Column) -> Column:
    return let(log_sum_exp(frame), lambda total: F.transform(frame, lambda x: x - total))


def is_log_probability(frame: Column) -> Column:
    """Whether the frame's probabilities already sum to one, within 1e-2 of the logarithm."""
    return F.abs(log_sum_exp(frame)) < 1e-2


def sliced(frames: Column, part: Slice) -> Column:
    """Log-probabilities of the block and the blank (which comes last), renormalised. Needs no normalisation before."""
    return F.transform(frames, lambda f: let(F.concat(F.slice(f, part.offset + 1, part.width), F.array(f[part.blank])), log_softmax))


def best_ids(frames: Column) -> Column:
    """The most likely id of each frame, the first of equals."""
    return F.transform(frames, lambda f: (F.array_position(f, F.array_max(f)) - 1).cast("int"))


def greedy(frames: Column, blank: int | Column) -> Column:
    """Most likely ids with repeats collapsed and blanks dropped."""
    return let(best_ids(frames), lambda best: F.filter(best, lambda x, i: (x != blank) & ((i == 0) | (x != F.get(best, i - 1)))))


def greedy_logprob(frames: Column) -> Column:
    return F.aggregate(frames, F.lit(0.0), lambda s, f: s + F.array_max(f).cast("double"))


def repeats(target: Column) -> Column:
    """Number of adjacent equal ids."""
    return F.size(F.filter(target, lambda x, i: (i > 0) & (x == F.get(target, i - 1))))


def forced_logprob(frames: Column, target: Column, blank: int) -> Column:
    """Score of the best path that emits exactly the target; null without target or frames.

    One step of the recurrence per frame: a state goes on from itself, from the
    one before, or from two before if no blank between them is due.
    """
    never, none = F.lit(NEVER), F.lit(blank)
    states = F.concat(F.flatten(F.transform(target, lambda t: F.array(none, t))), F.array(none))
    # of each state its id, and whether it can be reached from two before
    skips = lambda z: F.transform(z, lambda k, i: F.struct(k.alias("id"), ((i > 1) & (k != none) & (k != F.coalesce(F.get(z, i - 2), none))).alias("skip")))

    def last(z: Column) -> Column:
        start = F.transform(z, lambda k, i: F.when(i < 2, F.get(frames[0], k["id"]).cast("double")).otherwise(never))

        def step(acc: Column, frame: Column) -> Column:
            before = lambda i, n: F.coalesce(F.get(acc, i - n), never)
            return F.transform(z, lambda k, i: F.get(frame, k["id"]).cast("double") + F.greatest(F.get(acc, i), before(i, 1), F.when(k["skip"], before(i, 2)).otherwise(never)))

        return F.aggregate(F.slice(frames, 2, F.greatest(F.size(frames) - 1, F.lit(0))), start, step)

    best = let(let(let(states, skips), last), lambda end: F.greatest(F.element_at(end, -1), F.element_at(end, -2)))
    return F.when((F.size(target) > 0) & (F.size(frames) > 0), best)


def align(frames: np.ndarray, target: list[int], blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Token and score of each frame on the best path; of equals, staying comes first, then one step, then two."""
    z = np.full(2 * len(target) + 1, blank)
    z[1::2] = target
    skip = np.zeros(len(z), bool)
    skip[2:] = (z[2:] != blank) & (z[2:] != z[:-2])
    acc = np.full(len(z), NEVER)
    acc[:2] = frames[0, z[:2]]
    back = np.zeros((len(frames), len(z)), np.int8)
    for t in range(1, len(frames)):
        one = np.concatenate([[NEVER], acc[:-1]])
        two = np.where(skip, np.concatenate([[NEVER, NEVER], acc[:-2]])[: len(z)], NEVER)
        options = np.stack([acc, one, two])
        back[t] = options.argmax(0)
        acc = frames[t, z] + options.max(0)
    s = len(z) - 1 if acc[-1] >= acc[-2] else len(z) - 2
    path = np.empty(len(frames), np.int64)
    for t in range(len(frames) - 1, -1, -1):
        path[t] = z[s]
        s -= back[t, s]
    return path, frames[np.arange(len(frames)), path]


def align_udf(blank: int):
    """struct(path, scores) of frames and target; null where there is no alignment."""

    @F.pandas_udf("path array<int>, scores array<double>")
    def run(frames: pd.Series, target: pd.Series) -> pd.DataFrame:
        paths, scores = [], []
        for f, t in zip(frames, target):
            if f is None or t is None or not len(f) or not len(t) or len(f) < len(t) + sum(a == b for a, b in zip(t[1:], t)):
                paths.append(None)
                scores.append(None)
                continue
            path, score = align(np.stack([np.asarray(x, np.float64) for x in f]), list(t), blank)
            paths.append(path.tolist())
            scores.append(score.tolist())
        return pd.DataFrame({"path": pd.Series(paths, dtype=object), "scores": pd.Series(scores, dtype=object)})

    return run


def spans(path: Column, blank: int) -> Column:
    """Runs of equal tokens but blanks: array of struct(token, s, e), ends exclusive."""
    starts = F.filter(F.sequence(F.lit(0), F.size(path) - 1), lambda i: (F.get(path, i) != blank) & ((i == 0) | (F.get(path, i) != F.get(path, i - 1))))
    after = lambda i: F.filter(F.sequence(i, F.size(path)), lambda j: F.coalesce(F.get(path, j) != F.get(path, i), F.lit(True)))[0]
    return F.when(F.size(path) > 0, F.transform(starts, lambda i: F.struct(F.get(path, i).alias("token"), i.alias("s"), after(i).alias("e"))))


def token_scores(span: Column, scores: Column) -> Column:
    """Mean frame score of each span."""
    return F.transform(span, lambda x: F.aggregate(F.slice(scores, x["s"] + 1, x["e"] - x["s"]), F.lit(0.0), lambda a, y: a + y) / (x["e"] - x["s"]))


def mean_of(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, y: a + y) / F.size(values)).otherwise(F.lit(FAIL_SCORE))


def min_of(values: Column) -> Column:
    return F.coalesce(F.array_min(values), F.lit(FAIL_SCORE))


def boundaries(span: Column, shift: Column) -> Column:
    """Seconds: array of struct(token, start_sec, end_sec)."""
    return F.transform(span, lambda x: F.struct(x["token"].alias("token"), (x["s"] * shift).alias("start_sec"), (x["e"] * shift).alias("end_sec")))


def target_error(target: Column, n_classes: Column, n_frames: Column, blank: int) -> Column:
    """Why a target can't be aligned: none, ids that can't be, or too few frames; empty if it can."""
    wrong = F.filter(target, lambda t: (t < 0) | (t >= n_classes) | (t == blank))
    least = F.size(target) + repeats(target)
    return (
        F.when(F.coalesce(F.size(target), F.lit(0)) <= 0, "empty target")
        .when(F.size(wrong) > 0, F.concat(F.lit("invalid ids: "), F.array_join(F.slice(wrong, 1, 5).cast("array<string>"), ",")))
        .when(n_frames < least, F.concat(F.lit("too few frames: "), n_frames.cast("string"), F.lit(" < "), least.cast("string")))
        .otherwise("")
    )


def strip_ends(ids: Column, bos: int, eos: int) -> Column:
    """Without a first ``bos`` and a last ``eos``; negative ids are none."""
    head = F.when((F.lit(bos) >= 0) & (F.get(ids, F.lit(0)) == bos), F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))).otherwise(ids)
    last = F.try_element_at(head, F.lit(-1))
    return F.when((F.lit(eos) >= 0) & (last == eos), F.slice(head, 1, F.greatest(F.size(head) - 1, F.lit(0)))).otherwise(head)


def ids_to_text(ids: Column, vocabulary: list[str] | None) -> Column:
    """Vocabulary pieces joined, with word marks as spaces; without a vocabulary the ids."""
    if not vocabulary:
        return F.array_join(ids.cast("array<string>"), " ")
    pieces = F.array(*map(F.lit, vocabulary))
    return F.trim(F.replace(F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(pieces, i), F.lit("?"))), ""), F.lit("▁"), F.lit(" ")))


def text_to_ids(vocabulary: list[str]):
    """A UDF: greedy longest match against a vocabulary with word marks; what matches nothing is skipped."""
    numbers = {piece: i for i, piece in reversed(list(enumerate(vocabulary)))}
    longest = max(map(len, vocabulary), default=1)

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[int]:
            rest, out, at = "".join("▁" + w for w in (text or "").split()), [], 0
            while at < len(rest):
                n = next((n for n in range(min(longest, len(rest) - at), 0, -1) if rest[at : at + n] in numbers), 0)
                if n:
                    out.append(numbers[rest[at : at + n]])
                at += max(n, 1)
            return out

        return texts.map(one)

    return run
