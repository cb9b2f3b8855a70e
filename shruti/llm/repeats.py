"""Passages that repeat across documents: sparse suffix arrays, and FM-indexes in shards.

A window is ``size`` consecutive words of a document; it is a repeat if its
word sequence also starts in a document of smaller id. Of each window's k-grams
the least by hash is its anchor: equal windows have equal anchors, so windows
can only be equal within one anchor's group. Anchors seen in one document only
(nearly all) go at once; the others' surroundings are cut out as snippets, equal
snippets are collapsed, and groups of snippets form shards of bounded size.

``sparse_suffixes`` keeps one suffix per snippet, at its anchor: they are sorted,
neighbours compared for their common length, and matches extended to the left.
``fm_index`` indexes each shard's snippets and streams them through it: backward
search over a wavelet matrix gives the matching statistics of the places where
windows end (how many words before match elsewhere, up to a window's), and those
that reach the threshold report the least document of their interval. Both give, for each window
of a snippet, the smallest document that has it.

An anchor with very many different snippets (a passage in very many places) is
split into its windows, each a group of its own that pre-aggregates to one row,
so that no group grows with the number of documents. Texts of which nothing is
wanted are never shuffled (``met``), whatever the size of the corpus.

Defined results: a null or empty text has no words; rows with a null id are
neither removed from nor compared; documents of fewer words than a window have
no repeats; rows of equal id don't count as others; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, met, per_batch, scratch, stored, text_key, utf8
from .fm_index import FMIndex
from .hashing import ODD, U, doubled, mix, windows, words

CHUNK = 2 << 20
GRAM = 16
#: An anchor with more different snippets than this is split into windows.
MANY = 1000
SHARD_WORDS = 250_000


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Of each ``width`` consecutive values, the index of the first least one."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        reach += step
    return best[:n]


def runs(texts: list[bytes], size: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: doc (number of the text), at (first word), n (windows), off (anchor's word less at), anchor, snip."""
    hashes, offsets = words(texts, False)
    levels = doubled(hashes, size)
    grams = levels[GRAM]
    least = sliding_least(grams, size - GRAM + 1)
    if not len(least):
        return {c: np.zeros(0, np.int64) for c in ("doc", "at", "n", "off", "anchor", "snip")}
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + size <= offsets[doc + 1])
    if not len(start):
        return {c: np.zeros(0, np.int64) for c in ("doc", "at", "n", "off", "anchor", "snip")}
    anchor = least[start]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]))
    first, until = start[new], np.append(start[new[1:] - 1], start[-1]) + 1
    whole = windows(levels, size)
    off = anchor[new] - first
    snip = mix(mix(whole[first] * ODD[0] + whole[until - 1] * ODD[1]) + ((until - first) << 8 | off).astype(np.uint64))
    return {"doc": doc[first], "at": first - offsets[doc[first]], "n": until - first, "off": off, "anchor": grams[anchor[new]].view(np.int64), "snip": snip.view(np.int64)}


RUNS = "anchor long, snip long, doc_id long, ta long, at int, n short, off short"


def scan_runs(rows: DataFrame, size: int) -> DataFrame:
    """The runs of all rows, as ``RUNS``."""

    def run(batch: pa.RecordBatch):
        texts = utf8(batch)
        ids, tas = column(batch, "doc_id").to_numpy(), column(batch, "ta").to_numpy()
        for a, b in chunks([len(t) for t in texts], CHUNK):
            r = runs(texts[a:b], size)
            of = r["doc"] + a
            arrays = [r["anchor"], r["snip"], ids[of], tas[of], r["at"].astype(np.int32), r["n"].astype(np.int16), r["off"].astype(np.int16)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=[f.split()[0] for f in RUNS.split(", ")])

    return rows.select("doc_id", "ta", "text").mapInArrow(per_batch(run), RUNS)


def requests(df: DataFrame, *columns: str) -> DataFrame:
    """Per document (doc_id, ta) the list of its rows' ``columns``, stored."""
    return stored(df.groupBy("doc_id", "ta").agg(F.collect_list(F.struct(*columns)).alias("wanted")), "requests")


def with_requests(rows: DataFrame, wanted: DataFrame, how: str = "inner") -> DataFrame:
    """Texts meet what is wanted of them; only those of which something may be wanted are shuffled."""
    maybe, never = met(rows, wanted, "ta")
    found = maybe.join(wanted, ["doc_id", "ta"], how)
    return found if how == "inner" else found.unionByName(never, allowMissingColumns=True)


def of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``keys`` (stored)."""
    return met(rows, keys, key)[0].join(keys, key, "left_semi")


def split_windows(rows: DataFrame, hot: DataFrame, size: int) -> DataFrame:
    """The runs of much repeated anchors as single windows in ``RUNS``, each its own anchor, as far as they are in several documents."""

    def run(batch: pa.RecordBatch):
        texts, wanted = utf8(batch), column(batch, "wanted").to_pylist()
        ids, tas = column(batch, "doc_id").to_pylist(), column(batch, "ta").to_pylist()
        for i, text in enumerate(texts):
            whole = windows(doubled(words([text], False)[0], size), size)
            at = np.unique(np.concatenate([np.arange(w["at"], w["at"] + w["n"]) for w in wanted[i]]))
            key = mix(whole[at] * ODD[2] + ODD[3]).view(np.int64)
            one = np.ones(len(at), np.int16)
            arrays = [key, key, np.full(len(at), ids[i]), np.full(len(at), tas[i]), at.astype(np.int32), one, one * 0]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=[f.split()[0] for f in RUNS.split(", ")])

    made = stored(with_requests(rows, requests(hot, "at", "n")).select("doc_id", "ta", "wanted", "text").mapInArrow(per_batch(run), RUNS), "windows")
    shared = stored(made.groupBy("anchor").agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi")).where("_lo < _hi").select("anchor"), "shared-windows")
    return of_keys(made, shared, "anchor")


def shared_runs(rows: DataFrame, size: int) -> DataFrame:
    """The runs whose anchor is in several documents, those of much repeated anchors as windows."""
    every = stored(scan_runs(rows, size), "runs")
    several = every.groupBy("anchor").agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi")).where("_lo < _hi").select("anchor")
    shared = stored(of_keys(every, stored(several, "shared"), "anchor"), "shared-runs")
    kinds = shared.select("anchor", "snip").distinct().groupBy("anchor").count().where(F.col("count") > MANY).select("anchor")
    kinds = stored(kinds, "many")
    if not kinds.limit(1).count():
        return shared
    hot, rest = (shared.join(kinds, "anchor", how) for how in ("left_semi", "left_anti"))
    return stored(rest.unionByName(split_windows(rows, hot, size)), "split-runs")


def snippets(rows: DataFrame, shared: DataFrame, size: int) -> DataFrame:
    """shard, anchor, snip, least and most (documents), n, off and words (hashes) of each different snippet."""
    each = shared.groupBy("anchor", "snip").agg(F.min(F.struct("doc_id", "ta", "at")).alias("r"), F.max("doc_id").alias("most"), F.first("n").alias("n"), F.first("off").alias("off"))
    each = stored(each.select("anchor", "snip", "r.doc_id", "r.ta", "r.at", "most", "n", "off"), "snippets")
    total = each.agg(F.sum(F.col("n") + size - 1)).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    wanted = requests(each, "anchor", "snip", "at", "most", "n", "off")

    def run(batch: pa.RecordBatch):
        for doc, text, asked in zip(column(batch, "doc_id").to_pylist(), utf8(batch), column(batch, "wanted").to_pylist()):
            hashes = words([text], False)[0]
            out = [[w["anchor"], w["snip"], doc, w["most"], w["n"], w["off"], hashes[w["at"] : w["at"] + w["n"] + size - 1].tobytes()] for w in asked]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["anchor", "snip", "least", "most", "n", "off", "words"])

    cut = with_requests(rows, wanted).select("doc_id", "text", "wanted").mapInArrow(per_batch(run), "anchor long, snip long, least long, most long, n int, off int, words binary")
    # repeated rows of a document give its snippets again; one of each is enough
    return cut.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).dropDuplicates(["shard", "snip"])


def _unpacked(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The snippets in a fixed order, their words as numbers from 1, and where each begins (with one place between them)."""
    table = table.sort_by([("snip", "ascending"), ("least", "ascending")])
    parts = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    text[place] = np.unique(np.concatenate(parts), return_inverse=True)[1] + 1
    return table, text, starts


VERDICT = "snip long, lo int, hi int, least long"


def _verdict(table: pa.Table, owner: np.ndarray, place: np.ndarray, least: np.ndarray) -> pa.Table:
    """Runs of windows of a snippet with the same least document, where a later document has the snippet.

    owner, place, least: of each window, ordered by owner and place.
    """
    if not len(owner):
        return pa.table({"snip": pa.array([], pa.int64()), "lo": pa.array([], pa.int32()), "hi": pa.array([], pa.int32()), "least": pa.array([], pa.int64())})
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])]))
    end = np.append(new[1:], len(owner)) - 1
    most = table.column("most").to_numpy()[owner[new]]
    useful = least[new] < most
    snip = table.column("snip").to_numpy()[owner[new]]
    return pa.table({"snip": pa.array(snip[useful]), "lo": pa.array(place[new][useful].astype(np.int32)), "hi": pa.array(place[end][useful].astype(np.int32)), "least": pa.array(least[new][useful])})


def fm_index(size: int) -> Callable[[pa.Table], pa.Table]:
    """Verdicts of one shard: snippets stream through its FM-index, and where the matching statistics reach ``size`` words the interval's least document is reported."""

    def run(table: pa.Table) -> pa.Table:
        table, text, starts = _unpacked(table)
        index = FMIndex(text, int(text.max()) + 1)
        n = table.column("n").to_numpy().astype(np.int64)
        first = table.column("least").to_numpy()
        owner = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        least = first[owner].copy()
        holder = np.searchsorted(starts, index.order, "right") - 1
        docs = np.append(first[holder], np.iinfo(np.int64).max)
        ends = starts[owner] + place + size
        for a in range(0, len(owner), 1 << 17):
            length, lo, hi = index.statistics(text, ends[a : a + (1 << 17)], size)
            whole = np.flatnonzero(length >= size)
            if len(whole):
                cuts, back = np.unique(lo[whole], return_inverse=True)
                tops = np.zeros(len(cuts), np.int64)
                tops[back] = hi[whole]
                found = np.minimum.reduceat(docs, np.stack([cuts, tops], 1).ravel())[::2]
                least[a + whole] = found[back]
        return _verdict(table, owner, place, least)

    return run


def sparse_suffixes(size: int) -> Callable[[pa.Table], pa.Table]:
    """Verdicts of one shard by the order of the suffixes at its anchors."""

    def run(table: pa.Table) -> pa.Table:
        table, text, starts = _unpacked(table)
        n, off = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "off"))
        first = table.column("least").to_numpy()
        at = starts + off
        padded = np.concatenate([text, np.zeros(size, np.int64)])
        # a suffix ends with its snippet: the 0 after it and all behind count as nothing
        right = padded[at[:, None] + np.arange(size)]
        right[np.cumsum(right == 0, axis=1) > 0] = 0
        order = np.lexsort(right.T[::-1]) if len(at) else np.zeros(0, np.int64)
        ordered = right[order]
        differ = ordered[1:] != ordered[:-1]
        common = np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), size)])
        owners, places, leasts = [], [], []
        left = np.zeros(len(at), np.int64)  # numbers of the words to the left of the anchors, so far
        for back in range(size - GRAM + 1):
            if back:
                before = np.where(off >= back, padded[at - back], -1 - np.arange(len(at)))
                left = np.unique(left * (len(at) + len(text) + 2) + np.unique(before, return_inverse=True)[1], return_inverse=True)[1]
            group = np.empty(len(at), np.int64)
            group[order] = np.cumsum(common < size - back)  # neighbours that have the rest of the window in common
            _, key = np.unique(group * (len(at) + 1) + left, return_inverse=True)
            valid = (off >= back) & (off - back < n)
            best = np.full(len(at), np.iinfo(np.int64).max)
            np.minimum.at(best, key[valid], first[valid])
            owners.append(np.flatnonzero(valid))
            places.append(off[valid] - back)
            leasts.append(best[key[valid]])
        owner, place, least = np.concatenate(owners), np.concatenate(places), np.concatenate(leasts)
        by = np.lexsort((place, owner))
        return _verdict(table, owner[by], place[by], least[by])

    return run


def repeats(docs: DataFrame, method: Callable[[int], Callable[[pa.Table], pa.Table]], size: int = 50) -> DataFrame:
    """doc_id, ta, lo, hi, least: word ranges of each document that are covered by repeats, unmerged, and the least other document."""
    if size < 2 * GRAM:
        raise ValueError(f"windows of {2 * GRAM} words at least")
    rows = keyed(docs).where("doc_id is not null")
    with scratch(docs.sparkSession):
        shared = shared_runs(rows, size)
        verdicts = stored(snippets(rows, shared, size).groupBy("shard").applyInArrow(method(size), VERDICT), "verdicts")
        found = shared.select("snip", "doc_id", "ta", "at").join(verdicts, "snip").where("least < doc_id")
        found = found.select("doc_id", "ta", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi") + size).alias("hi"), "least").distinct()
        return stored(found, "repeats", keep=True)


def keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", text_key()[0].alias("ta"), "text")


def merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def spans(docs: DataFrame, method=sparse_suffixes, size: int = 50) -> DataFrame:
    """doc_id, first_doc_id, start_word, end_word, n_words: the repeated passages of each document, and the smallest document that has part of it."""
    found = requests(repeats(docs, method, size), "lo", "hi", "least")

    def run(batch: pa.RecordBatch):
        for doc, wanted in zip(column(batch, "doc_id").to_pylist(), column(batch, "wanted").to_pylist()):
            rows = [(doc, min(w["least"] for w in wanted if a <= w["lo"] < b), a, b, b - a) for a, b in merged([(w["lo"], w["hi"]) for w in wanted])]
            names = ["doc_id", "first_doc_id", "start_word", "end_word", "n_words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return found.mapInArrow(per_batch(run), "doc_id long, first_doc_id long, start_word long, end_word long, n_words long")


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def removed(docs: DataFrame, method=fm_index, size: int = 50, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words that stay, joined by one space; null unless asked for)."""
    found = requests(repeats(docs, method, size), "lo", "hi")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, digests, texts = [], [], [], []
        for text, wanted in zip(utf8(batch), column(batch, "wanted").to_pylist()):
            split = text.split()
            n_words.append(len(split))
            for a, b in reversed(merged([(w["lo"], w["hi"]) for w in wanted or ()])):
                del split[a:b]
            n_removed.append(n_words[-1] - len(split))
            kept = b" ".join(split)
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode() if with_text else None)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(c, k) for c, k in zip((n_words, n_removed, digests, texts), kinds))], names=[f.split()[0] for f in KEPT.split(", ")])

    return with_requests(keyed(docs), found, "left").select("doc_id", "text", "wanted").mapInArrow(per_batch(run), KEPT)


def digest(docs: DataFrame, size: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document, by FM-indexes."""
    return removed(docs, fm_index, size).drop("kept")
