"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark items become windows of 13 words (an item of fewer words is one
window). The windows are searched in the normalised documents with Wu-Manber:
a block shift table skips positions that no window can end its prefix at, the
hash of the block there selects a bucket of windows, and direct comparison
confirms an occurrence. The scan runs in lockstep lanes over a buffer of many
documents, so each skip is one array operation.

Documents are never shuffled or collected. The benchmark's size is checked: it
is cut into blocks of ``block_bytes`` of text, and each block is one more pass
over the rows of the same scan, so no task holds more than one block's tables.

Defined results: a null or empty text has no words, no hits and is not
contaminated; items without words are ignored; a null item id is listed as an
empty string; repeated rows and repeated items each count for themselves
(``n_items`` counts distinct ids); an empty benchmark hits nothing; other
columns of the input pass through the filter and are ignored by the scan.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, column, fresh, per_batch, utf8

#: Fixed values of the contract: A-Z are lower-cased; of ASCII, only digits and letters are word characters.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]")
NORMAL = bytes(c if _WORD.match(bytes([c])) else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: No byte of UTF-8; stands between documents.
GAP = b"\xff"
BLOCK, TABLE_BITS, MULT = 8, 20, np.uint64(0x9E3779B97F4A7C15)


def windows(text: bytes, width: int) -> list[bytes]:
    """The item's windows, as searched: words between single spaces."""
    words = text.translate(NORMAL).split()
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + width]) + b" " for i in range(max(1, len(words) - width + 1))]


class WuManber:
    """Tables for patterns of at least one byte; the shortest one sets the width of the prefix that is searched."""

    def __init__(self, patterns: list[bytes]):
        self.m = m = min(map(len, patterns))
        self.block = b = min(BLOCK, m)
        self.shift = np.full(1 << TABLE_BITS, m - b + 1, np.uint16 if m < 60000 else np.uint32)
        self.buckets: dict[bytes, list[int]] = {}
        self.patterns = patterns
        for q in range(b, m + 1):  # blocks that end at q in the prefixes
            raw = b"".join(p[q - b : q].ljust(8, b"\0") for p in patterns)
            self.shift[self._hash(np.unique(np.frombuffer(raw, "<u8")))] = m - q
        for i, p in enumerate(patterns):
            self.buckets.setdefault(p[m - b : m], []).append(i)

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        return ((codes * MULT) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, text: bytes) -> tuple[list[int], list[int]]:
        """Starts and pattern numbers of all occurrences."""
        n, m, b = len(text), self.m, self.block
        starts, found = [], []
        if n < m:
            return starts, found
        padded = text + b"\0" * 8
        codes = np.ndarray((n,), "<u8", padded, strides=(1,))  # the eight bytes at each position
        keep = np.uint64((1 << (8 * b)) - 1)
        lanes = max(1, min(8192, n // 512))
        edges = np.linspace(m, n + 1, lanes + 1).astype(np.int64)  # a lane looks at prefixes that end in its own range
        at, until = edges[:-1].copy(), edges[1:]
        while len(at := at[live := at < until]):
            until = until[live]
            step = self.shift[self._hash(codes[at - b] & keep)].astype(np.int64)
            for end in at[step == 0].tolist():
                for i in self.buckets.get(text[end - b : end], ()):
                    if text.startswith(self.patterns[i], end - m):
                        starts.append(end - m)
                        found.append(i)
            at = at + np.maximum(step, 1)
        return starts, found


class Matcher:
    """Windows of one block of items, long and short ones apart, so that a short item doesn't shorten the skips of all."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for w in windows(text, width):
                owners.setdefault(w, set()).add(item)
        self.parts = []
        for of in (lambda w: len(w) >= 32, lambda w: len(w) < 32):
            if some := sorted(w for w in owners if of(w)):
                self.parts.append((WuManber(some), [w.count(b" ") - 1 for w in some], [sorted(owners[w]) for w in some]))

    def hits(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Of each text: number of words, hit ranges of words, ids of items with occurring windows."""
        normal = (b" " + GAP + b" ").join(t.replace(GAP, b" ") for t in texts).translate(NORMAL)
        text = b" " + b" ".join(normal.split()) + b" "
        raw = np.frombuffer(text, np.uint8)
        word_at = np.cumsum(raw == 32, dtype=np.int64) - 1  # of a space: the number of words before it
        gaps = np.flatnonzero(raw == GAP[0])
        first = np.concatenate([[0], word_at[gaps] + 1])
        until = np.append(word_at[gaps], word_at[-1])
        out = [(int(n), [], set()) for n in until - first] if len(text) > 2 else [(0, [], set()) for _ in texts]
        for tables, sizes, owners in self.parts:
            starts, found = tables.find(text)
            if not starts:
                continue
            words = word_at[np.array(starts)]
            docs = np.searchsorted(first, words, "right") - 1
            for doc, word, i in zip(docs.tolist(), (words - first[docs]).tolist(), found):
                out[doc][1].append((word, word + sizes[i]))
                out[doc][2].update(owners[i])
        return out


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def blocks(benchmark: DataFrame, block_bytes: int) -> list[list[tuple[str, bytes]]]:
    """The items in blocks of bounded size; a benchmark under the bound is one block."""
    out: list[list[tuple[str, bytes]]] = []
    total = block_bytes
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t")).distinct()
    for r in rows.toLocalIterator():
        if total >= block_bytes:
            out.append([])
            total = 0
        out[-1].append((r.i, r.t.encode()))
        total += len(out[-1][-1][1])
    return out


#: What a scan adds: number of words, hit word ranges (flat), number of hit words, ids of the items with occurring windows.
ADDED = {"n_words": T.LongType(), "ranges": T.ArrayType(T.LongType()), "n_hit": T.LongType(), "items": T.ArrayType(T.StringType())}


def scan(docs: DataFrame, benchmark: DataFrame, width: int = 13, block_bytes: int = 8 << 20, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns of ``ADDED``, and these columns' names, which ``docs`` doesn't have; one pass for each block of the benchmark, within one stage."""
    names = fresh(docs, *ADDED)
    added = [T.StructField(n, kind) for n, kind in zip(names, ADDED.values())]
    out = docs
    for items in blocks(benchmark, block_bytes) or [[]]:
        out = out.mapInArrow(per_batch(_pass(items, width, text, len(docs.columns), names)), T.StructType([*docs.schema.fields, *added]))
    return out, names


def _pass(items: list[tuple[str, bytes]], width: int, text: str, n_columns: int, names: list[str]):
    made: list[Matcher] = []

    def run(batch: pa.RecordBatch):
        if not made:
            made.append(Matcher(items, width))
        texts = utf8(batch, text)
        for a, b in chunks([len(t) for t in texts], 4 << 20):
            part = batch.slice(a, b - a)
            before = [column(part, c).to_pylist() if batch.num_columns > n_columns else [[]] * (b - a) for c in (names[1], names[3])]
            n_words, ranges, n_hit, ids = [], [], [], []
            for (n, new, owners), old, known in zip(made[0].hits(texts[a:b]), *before):
                all_ranges = merged(new + list(zip(old[::2], old[1::2])))
                n_words.append(n)
                ranges.append([x for r in all_ranges for x in r])
                n_hit.append(sum(y - x for x, y in all_ranges))
                ids.append(sorted(owners.union(known)))
            added = [pa.array(v, k) for v, k in zip((n_words, ranges, n_hit, ids), (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([*part.columns[:n_columns], *added], names=[*batch.schema.names[:n_columns], *names])

    return run


def contaminated(n_words: str, n_hit: str) -> Column:
    """The contract's rule, on a scan: some hit words, and at least a twentieth of all."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def digest(docs: DataFrame, benchmark: DataFrame, width: int = 13, block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out, (n_words, _, n_hit, items) = scan(rows, benchmark, width, block_bytes)
    return out.select(
        "doc_id", n_words, n_hit, F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), contaminated(n_words, n_hit).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    out, names = scan(docs, benchmark, width, block_bytes)
    return out.where(~contaminated(names[0], names[2])).drop(*names)
