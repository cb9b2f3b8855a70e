"""Acoustic models and recognisers behind one protocol, run per Arrow batch.

No model ships here; ``FakeBackend`` is deterministic and serves tests. A real
backend is made once per Python worker and reads its files there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = 64


class Backend(Protocol):
    def logits(self, wav: np.ndarray) -> np.ndarray:
        """Frames by classes for 16 kHz mono samples."""

    def transcribe(self, wavs: list[np.ndarray], language: str) -> list[str | None]:
        """A transcript for each waveform."""


class FakeBackend:
    """Frames and words from a hash of the samples: equal sounds, equal results."""

    def __init__(self, classes: int = 9, words: tuple[str, ...] = ("alpha", "beta", "gamma", "delta")):
        self.classes, self.words = classes, words

    def _random(self, wav: np.ndarray) -> np.random.Generator:
        return np.random.default_rng(int.from_bytes(hashlib.blake2b(np.asarray(wav, np.float32).tobytes(), digest_size=8).digest(), "big"))

    def logits(self, wav: np.ndarray) -> np.ndarray:
        return self._random(wav).normal(size=(max(1, len(wav) // 1280), self.classes))

    def transcribe(self, wavs: list[np.ndarray], language: str) -> list[str | None]:
        if any(not len(w) for w in wavs):
            raise ValueError("no samples")
        return [" ".join(self.words[i] for i in self._random(w).integers(0, len(self.words), 4)) for w in wavs]


def _one_by_one(call: Callable, items: list) -> list[tuple]:
    """(result, error) of each; a batch that fails is tried item by item, so one bad row doesn't take others along."""
    try:
        return [(r, None) for r in call(items)]
    except Exception as whole:  # a model may raise anything; it becomes a column
        if len(items) <= 1:
            return [(None, f"{type(whole).__name__}: {whole}") for _ in items]
        return [pair for x in items for pair in _one_by_one(call, [x])]


def transcribe(rows: DataFrame, make: Callable[[], Backend], language: str, batch: int = BATCH, carry: tuple[str, ...] = ("utt_id",)) -> DataFrame:
    """``carry`` columns of ``rows`` (and wav) with hypothesis and error; no text is the empty one. Rows without samples (null) are errors that the model never sees."""
    kept = [rows.schema[c] for c in carry]
    schema = T.StructType([*kept, T.StructField("hypothesis", T.StringType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make()
        for part in batches:
            for a in range(0, len(part), batch):
                some = part.iloc[a : a + batch]
                wavs = [None if w is None else np.asarray(w, np.float32) for w in some["wav"]]
                said = iter(_one_by_one(lambda ws: backend.transcribe(ws, language), [w for w in wavs if w is not None]))
                found = [(None, "no audio") if w is None else next(said) for w in wavs]
                yield pd.DataFrame({**{c: some[c].values for c in carry}, "hypothesis": [(r or "") if e is None else None for r, e in found], "error": [e for _, e in found]})

    return rows.select(*carry, "wav").mapInPandas(run, schema)


def frames(rows: DataFrame, make: Callable[[], Backend], carry: tuple[str, ...] = ("utt_id",)) -> DataFrame:
    """``carry`` columns of ``rows`` (and wav) with frames of raw outputs and error, which rows without samples (null) have."""
    kept = [rows.schema[c] for c in carry]
    schema = T.StructType([*kept, *T._parse_datatype_string("frames array<array<double>>, error string").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make()
        for part in batches:
            for i, wav in enumerate(part["wav"]):
                ((found, error),) = [(None, "no audio")] if wav is None else _one_by_one(lambda ws: [backend.logits(w) for w in ws], [np.asarray(wav, np.float32)])
                yield pd.DataFrame({**{c: part[c].iloc[i : i + 1].values for c in carry}, "frames": [None if found is None else [list(map(float, f)) for f in found]], "error": [error]})

    return rows.select(*dict.fromkeys((*carry, "wav"))).mapInPandas(run, schema)


def marked(transcripts: DataFrame, marker: str) -> DataFrame:
    """Failure marker where there is no hypothesis."""
    return transcripts.withColumn("hypothesis", F.coalesce("hypothesis", F.lit(marker)))
