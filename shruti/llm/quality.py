"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting fits one shallow tree per feature and turn to the residuals;
the trees of a feature add up to one lookup table over its bins. The pairs of
features with the largest gains then get two-dimensional tables in the same
way. A score is a sum of table entries, found for whole batches by bin numbers.

Labels are read from at most ``max_train`` rows (a hash-ordered sample; the
bound is the parameter), so the driver holds a fixed number of feature rows.
Every text is scored in one pass without a shuffle.

Defined results: a null or empty text is scored like any text (its features are
zeros); rows without label aren't trained on; of repeated label rows the largest
label counts and of repeated documents one; with no labels, or labels of one
kind only, all scores are the smoothed share of label 1; null labels are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, fresh, per_batch, strings

FEATURES = ("log_chars", "log_words", "word_length", "distinct_words", "repeated_words", "upper", "digits", "stops", "marks", "other_marks", "non_ascii", "entropy", "short_words", "line_words", "distinct_lines", "longest_word")
_BYTES = np.zeros(256, np.int64)  # classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 full stop and comma, 6 common marks, 7 other marks, 8 non-ASCII
for _c in range(256):
    _s = chr(_c)
    _BYTES[_c] = 8 if _c > 127 else 1 if _s.islower() else 2 if _s.isupper() else 3 if _s.isdigit() else 4 if _s.isspace() else 5 if _s in ".," else 6 if _s in ";:!?'\"()-" else 7 if _c > 32 else 0


def features(text: str) -> list[float]:
    """Numbers about the text alone, in the order of ``FEATURES``."""
    raw = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    kinds = np.bincount(_BYTES, counts, 9) / n
    share = counts[counts > 0] / n
    words = text.split()
    m = max(1, len(words))
    lines = text.split("\n")
    lengths = [len(w) for w in words]
    return [
        float(np.log1p(len(raw))), float(np.log1p(len(words))), sum(lengths) / m, len(set(words)) / m, sum(map(str.__eq__, words, words[1:])) / m,
        kinds[2], kinds[3], kinds[5], kinds[6], kinds[7], kinds[8], float(-(share * np.log2(share)).sum()), sum(k <= 2 for k in lengths) / m,
        float(np.log1p(m / len(lines))), len(set(lines)) / len(lines), float(np.log1p(max(lengths, default=0))),
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)  # per feature, upper bounds of its bins but the last
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(x), 0), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            z += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _cuts(g: np.ndarray, h: np.ndarray, least: float) -> np.ndarray:
    """Gains of cutting after each bin but the last."""
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    c, d = g.sum() - a, h.sum() - b
    gain = a * a / (b + 1) + c * c / (d + 1) - g.sum() ** 2 / (h.sum() + 1)
    return np.where((b < least) | (d < least), -1.0, gain)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int, least: float) -> np.ndarray:
    """Leaf values per bin of a tree that fits the residuals' histogram."""
    if depth and len(g) > 1 and (gain := _cuts(g, h, least)).max() > 1e-9:
        cut = int(gain.argmax()) + 1
        return np.concatenate([shallow_tree(g[:cut], h[:cut], depth - 1, least), shallow_tree(g[cut:], h[cut:], depth - 1, least)])
    return np.full(len(g), g.sum() / (h.sum() + 1))


def quadrants(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree with one cut on each axis."""
    a, b = (x.cumsum(0).cumsum(1) for x in (g, h))
    best, values = 0.0, np.zeros_like(g)
    if min(g.shape) < 2:
        return best, values

    def parts(s: np.ndarray):
        low = s[:-1, :-1]
        return low, s[:-1, -1:] - low, s[-1:, :-1] - low, s[-1, -1] - s[:-1, -1:] - s[-1:, :-1] + low

    gain = sum(np.where(hh < least, 0.0, gg * gg / (hh + 1)) for gg, hh in zip(parts(a), parts(b)))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    best = float(gain[i, j] - g.sum() ** 2 / (h.sum() + 1))
    if best > 1e-9:
        for rows in (slice(None, i + 1), slice(i + 1, None)):
            for cols in (slice(None, j + 1), slice(j + 1, None)):
                gg, hh = g[rows, cols].sum(), h[rows, cols].sum()
                values[rows, cols] = gg / (hh + 1) if hh >= least else 0.0
    return best, values


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, n_pairs: int = 6, n_bins: int = 32, rate: float = 0.15, depth: int = 2, least: float = 2.0) -> Model:
    """The model of labels ``y`` (0 or 1); with one kind of label only, its smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])))
    b = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    z = np.full(len(y), model.intercept)
    residual = lambda: (y - (p := 1 / (1 + np.exp(-z))), p * (1 - p))
    for _ in range(rounds):
        for j, s in enumerate(sizes):
            g, h = residual()
            step = rate * shallow_tree(np.bincount(b[:, j], g, s), np.bincount(b[:, j], h, s), depth, least)
            model.tables[j] += step
            z += step[b[:, j]]
    flat = {(i, j): b[:, i] * sizes[j] + b[:, j] for i in range(len(sizes)) for j in range(i)}
    grid = lambda k, v: np.bincount(flat[k], v, sizes[k[0]] * sizes[k[1]]).reshape(sizes[k[0]], sizes[k[1]])
    g, h = residual()
    model.pairs = sorted(flat, key=lambda k: (-quadrants(grid(k, g), grid(k, h), least)[0], k))[:n_pairs]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, t in zip(model.pairs, model.pair_tables):
            g, h = residual()
            step = rate * quadrants(grid(k, g), grid(k, h), least)[1]
            t += step
            z += step[b[:, k[0]], b[:, k[1]]]
    return model


def fold_of(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 3; 1 is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> Model:
    """The model fitted to a bounded sample of the labelled rows that aren't held out."""
    spark = docs.sparkSession
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(fold_of() != 1)
    sample = usable.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).collect()
    if not sample:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    sample_df = spark.createDataFrame([(r.doc_id, r.y) for r in sample], "doc_id long, y int")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample_df), "doc_id")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(strings(batch))
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    rows = chosen.select("doc_id", "y", "text").mapInArrow(per_batch(measure), "doc_id long, y int, x array<double>")
    found = rows.groupBy("doc_id", "y").agg(F.min("x").alias("x")).collect()  # a row for each of the sample at most
    found.sort(key=lambda r: r.doc_id)
    return fit(np.array([r.x for r in found]).reshape(len(found), len(FEATURES)), np.array([r.y for r in found], np.float64))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column of scores."""
    fields = [f for f in docs.schema.fields if f.name != name]
    names = [f.name for f in fields]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(matrix(strings(batch))))], names=[*names, name])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(per_batch(run), T.StructType([*fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(rows, train(docs, labels, max_train))
    return scored.select("doc_id", (fold_of() == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    (name,) = fresh(docs, "score")
    return score(docs, train(docs, labels, max_train), name).where(F.col(name) >= threshold).drop(name)
