"""Best-two-fit packing of documents into fixed-length token sequences.

A bin is filled greedily, largest piece first; then its smallest piece is
replaced by the two unpacked pieces that fill the widened gap most tightly.
Pieces of equal length are interchangeable, so the plan is made on the
histogram of lengths (at most ``size`` counters, whatever the corpus): the
driver makes bin patterns with multiplicities, and each piece finds its slot
from its rank among the pieces of its length. Nothing else reaches the driver,
and no task holds more than one Arrow batch of texts.

Defined results: a null or empty text is the single closing id; repeated rows
are packed once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, column, per_batch, stored, strings

#: Ranks within a length are taken per salt, so that no length is one task.
SALTS = 512


def load_encoder(path: str):
    """An encoder of batches of texts to id arrays, giving the ids of the tokenizers file at ``path``.

    The same vocabulary as ranks (``.tiktoken`` beside the ``.json``) encodes
    four times as fast and to the same ids; the few texts that it refuses, and
    those with the literal of an added token, which tokenizers gives that
    token's id, go through tokenizers. Without a ranks file everything does.
    """
    import json
    import os

    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    slow = Tokenizer.from_file(path)
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_path):
        return lambda texts: [np.array(e.ids, "<u4") for e in slow.encode_batch(texts, add_special_tokens=False)]
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f).get("added_tokens") or ()]
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def one(text: str) -> np.ndarray:
        if not any(t in text for t in added):
            try:
                return np.array(quick.encode_ordinary(text), "<u4")
            except BaseException as e:  # the Rust side panics on some extreme runs; its exception's class can't be imported
                if type(e).__name__ != "PanicException":
                    raise
        return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")

    return lambda texts: [one(t) for t in texts]


_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    if path not in _ENCODERS:
        _ENCODERS[path] = load_encoder(path)
    return _ENCODERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``size`` ids; only the first piece of a longer document may be shorter."""

    def cut(batch: pa.RecordBatch):
        texts, ids = strings(batch), column(batch, "doc_id").to_pylist()
        encode = encoder(tokenizer)
        for a, b in chunks([len(t) for t in texts], 1 << 20):
            rows: list[list] = [[], [], [], [], [], []]
            for doc, got in zip(ids[a:b], encode(texts[a:b])):
                got = np.append(got, np.array([end_id], "<u4"))
                first = len(got) % size or size
                at = 0
                for k in range(1 + (len(got) - first) // size):
                    part = got[at : at + (size if k else first)]
                    raw = part.tobytes()
                    for col, v in zip(rows, (doc, k, at, len(part), zlib.crc32(raw), raw if with_ids else None)):
                        col.append(v)
                    at += len(part)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(per_batch(cut), PIECES)


@dataclass
class Slots:
    """Where the pieces of each length go: ranks ``[first, first + bins * k)`` of ``length`` fill ``k`` places in each of ``bins`` bins."""

    key: np.ndarray  # length << 40 | first rank
    first_bin: np.ndarray
    k: np.ndarray
    at: np.ndarray  # index of the first of its k offsets
    offsets: np.ndarray


def fill_bin(counts: list[int], mask: int, size: int) -> list[int]:
    """One bin by best-two-fit from the lengths that ``counts`` still has (``mask``: bit per length left)."""
    left = dict[int, int]()
    take, gap, free = [], size, mask
    while gap and (n := (free & ((1 << (gap + 1)) - 1)).bit_length() - 1) > 0:
        take.append(n)
        gap -= n
        left[n] = left.get(n, counts[n]) - 1
        if not left[n]:
            free &= ~(1 << n)
    if gap and len(take) > 1:
        small = take[-1]
        room, best, pair = gap + small, small, None
        a = room - 1
        while a > 0 and (a := (free & ((1 << (a + 1)) - 1)).bit_length() - 1) > 0 and 2 * a >= best:
            rest = free & ((1 << (min(a, room - a) + 1)) - 1)
            if a <= room - a and left.get(a, counts[a]) < 2:
                rest &= ~(1 << a)
            b = rest.bit_length() - 1
            if b > 0 and a + b > best:
                best, pair = a + b, (a, b)
                if best == room:
                    break
            a -= 1
        if pair:
            take[-1:] = pair
    return take


def plan(histogram: dict[int, int], size: int) -> tuple[Slots, int]:
    """Bin patterns for a histogram of lengths, each used as long as its lengths last."""
    counts = [0] * (size + 1)
    for n, c in histogram.items():
        counts[n] = c
    mask = sum(1 << n for n, c in enumerate(counts) if c and n)
    used = [0] * (size + 1)
    rows, offsets, bins = [], [], 0
    while mask:
        take = fill_bin(counts, mask, size)
        need: dict[int, int] = {}
        for n in take:
            need[n] = need.get(n, 0) + 1
        times = min(counts[n] // k for n, k in need.items())
        at = 0
        for n, k in need.items():
            rows.append((n << 40 | used[n], bins, k, len(offsets)))
            offsets += range(at, at + n * k, n)
            at += n * k
            used[n] += k * times
            counts[n] -= k * times
            if not counts[n]:
                mask &= ~(1 << n)
        bins += times
    rows.sort()
    key, first_bin, k, at = (np.array(c, np.int64) for c in (zip(*rows) if rows else ([], [], [], [])))
    return Slots(key, first_bin, k, at, np.array(offsets, np.int64)), bins


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence: doc_id, piece, start, length, ids_crc32, ids (null unless asked for), sequence_id, offset.

    Texts are tokenised once; the pieces are stored, so that ranks and plan
    always see the same rows.
    """
    cut = stored(pieces(docs, tokenizer, size, end_id, with_ids), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `size` rows
    slots, _ = plan(histogram, size)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    before = (
        salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "_salt", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    # The counts go along as rows of their own: a window instead of a join, so a crowded length is spread over its salts.
    group = Window.partitionBy("length", "_salt")
    marked = salted.withColumn("_before", F.lit(None).cast("long")).unionByName(before, allowMissingColumns=True)
    ranked = (
        marked.withColumn("_base", F.max("_before").over(group))
        .withColumn("_at", F.row_number().over(group.orderBy(F.col("_before").isNotNull(), "doc_id", "piece", "start", "ids_crc32")))
        .where("_before is null").withColumn("_rank", F.col("_base") + F.col("_at") - 1)
        .select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "_rank")
    )

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        rank, length = (column(batch, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_rank", "length"))
        row = np.searchsorted(slots.key, length << 40 | rank, "right") - 1
        nth = rank - (slots.key[row] & ((1 << 40) - 1))
        k = slots.k[row]
        out = [column(batch, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")]
        out += [pa.array(slots.first_bin[row] + nth // k), pa.array(slots.offsets[slots.at[row] + nth % k])]
        return pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"])

    return ranked.mapInArrow(per_batch(place), PIECES + ", sequence_id long, offset long")
