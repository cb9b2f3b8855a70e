"""Waveforms as arrays: level, noise estimate, channels, segments; and resampling in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

#: The published table of ln(mean |x|) - mean(ln |x|) at -20, -19, ..., 100 dB for a shape of 0.4.
WADA_TABLE = [
    0.40974774, 0.40986926, 0.40998566, 0.41010534, 0.4102188, 0.4103374, 0.41045077, 0.4105655, 0.4106772, 0.4107877,
    0.4108982, 0.41100943, 0.41111982, 0.41122933, 0.41133794, 0.41144565, 0.41155243, 0.41165827, 0.41176314, 0.41186705,
    0.41196995, 0.41207185, 0.41217272, 0.41227254, 0.4123713, 0.412469, 0.41256564, 0.4126612, 0.41275568, 0.41284908,
    0.41294137, 0.41303257, 0.41312267, 0.41321166, 0.41329953, 0.4133863, 0.41347195, 0.41355647, 0.41363988, 0.41372216,
    0.41380334, 0.41388337, 0.41396229, 0.41404008, 0.41411675, 0.4141923, 0.41426672, 0.41434003, 0.41441221, 0.41448327,
    0.41455322, 0.41462205, 0.41468976, 0.41475636, 0.41482186, 0.41488624, 0.41494953, 0.41501172, 0.41507282, 0.41513283,
    0.41519176, 0.4152496, 0.41530637, 0.41536206, 0.41541668, 0.41547023, 0.41552272, 0.41557414, 0.41562451, 0.41567382,
    0.41572209, 0.41576931, 0.41581549, 0.41586064, 0.41590475, 0.41594783, 0.41598989, 0.41603093, 0.41607095, 0.41610996,
    0.41614796, 0.41618496, 0.41622096, 0.41625597, 0.41628999, 0.41632303, 0.41635508, 0.41638616, 0.41641626, 0.41644540,
    0.41647358, 0.41650080, 0.41652708, 0.41655241, 0.41657681, 0.41660028, 0.41662283, 0.41664447, 0.41666521, 0.41668506,
    0.41670402, 0.41672211, 0.41673933, 0.41675570, 0.41677122, 0.41678590, 0.41679975, 0.41681279, 0.41682502, 0.41683645,
    0.41684709, 0.41685695, 0.41686604, 0.41687437, 0.41688195, 0.41688880, 0.41689491, 0.41690031, 0.41690500, 0.41690899,
    0.41691231,
]
FLOOR, FIRST_DB = 1e-10, -20.0
RATE = 16_000


def level_statistic(wav: Column) -> Column:
    """ln(mean |x|) - mean(ln |x|), with |x| of at least FLOOR; null for an empty array."""
    sums = F.aggregate(
        wav,
        F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("l")),
        lambda s, x: F.struct((s["a"] + F.greatest(F.abs(x.cast("double")), F.lit(FLOOR))).alias("a"), (s["l"] + F.ln(F.greatest(F.abs(x.cast("double")), F.lit(FLOOR)))).alias("l")),
    )
    n = F.size(wav)
    return F.when(n > 0, F.ln(sums["a"] / n) - sums["l"] / n)


def wada_snr(wav: Column, table: list[float] = WADA_TABLE, statistic: Column | None = None) -> Column:
    """Blind noise estimate in dB: the statistic's place in the table, linear between entries, clamped at its ends; NaN for no samples and where one is NaN or infinite.

    statistic: the column of ``level_statistic``, where it is there already (it is used several times).
    """
    v = level_statistic(wav) if statistic is None else statistic
    g = F.array(*map(F.lit, table))
    finite = F.exists(wav, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))

    def between(below: Column) -> Column:  # entries under v: the last of them starts the interval
        lo, hi = F.element_at(g, below), F.element_at(g, below + 1)
        return F.lit(FIRST_DB) + (below - 1) + (v - lo) / (hi - lo)

    inside = let(F.size(F.filter(g, lambda y: y < v)), between)
    last = FIRST_DB + len(table) - 1
    known = F.when(F.isnan(v), F.lit(float("nan"))).when(v <= table[0], F.lit(FIRST_DB)).when(v >= table[-1], F.lit(last)).otherwise(inside)
    return F.when(F.coalesce((F.size(wav) > 0) & finite, F.lit(False)), known).otherwise(F.lit(float("nan")))


def mono(channels: Column) -> Column:
    """Mean over channels of an array of equally long channels."""
    return F.transform(F.arrays_zip(channels[0], channels[0]), lambda x, i: F.aggregate(channels, F.lit(0.0), lambda s, c: s + F.get(c, i).cast("double")) / F.size(channels))


def unit_scaled(wav: Column) -> Column:
    """16-bit integer samples to the unit range, where any is beyond it."""
    beyond = F.exists(wav, lambda x: F.abs(x) > 1)
    return F.when(beyond, F.transform(wav, lambda x: x / 32768.0)).otherwise(F.transform(wav, lambda x: x.cast("double")))


def segment(wav: Column, rate: Column, start: Column, end: Column, rounding: str = "offset_first") -> Column:
    """The samples of a time range. rounding: how frame numbers come about.

    offset_first: from int(s r), int(e r) - that many, one at least; joint: from int(s r), int(e r - int(s r)) many; ends: from int(s r) up to int(e r).
    """
    off = (start * rate).cast("int")
    n = {
        "offset_first": F.greatest((end * rate).cast("int") - off, F.lit(1)),
        "joint": (end * rate - off).cast("int"),
        "ends": (end * rate).cast("int") - off,
    }[rounding]
    return F.when(start.isNull(), wav).otherwise(F.slice(wav, off + 1, F.greatest(n, F.lit(0))))


def resample(wav: np.ndarray, rate: int, to: int = RATE, width: int = 6, rolloff: float = 0.99) -> np.ndarray:
    """Windowed-sinc interpolation (Hann), evaluated phase by phase. Not bit-exact with any other library."""
    if rate == to or not len(wav):
        return np.asarray(wav, np.float32)
    g = np.gcd(rate, to)
    old, new = rate // g, to // g
    cut = min(old, new) * rolloff
    reach = int(np.ceil(width * old / cut))
    at = np.arange(-reach, reach + old)[None, :] / old
    phase = -np.arange(new)[:, None] / new
    t = np.clip((phase + at) * cut, -width, width)
    kernel = np.sinc(t) * np.cos(t * np.pi / width / 2) ** 2 * cut / old
    padded = np.pad(np.asarray(wav, np.float64), (reach, reach + old))
    frames = np.lib.stride_tricks.sliding_window_view(padded, kernel.shape[1])[::old]
    out = (frames @ kernel.T).reshape(-1)
    return out[: -(-new * len(wav) // old)].astype(np.float32)
