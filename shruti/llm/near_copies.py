"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets, and its connected classes.

Documents with equal sets are one class from the start; the join is between
sets. Light sets (few shingles) enumerate their subsets of each fixed size that a
similar set can share with them: two sets are similar exactly if they share such
a subset and miss few enough elements beside it, so the sets of one subset form
a star around the one that misses least, and nothing is compared. Heavy sets are
found through inverted lists of their rarest shingles. The boundary is the one
with the lowest estimated cost over the histogram of sizes.

A scan of the lists finds candidates: pairs that sizes, positions in the list and
count vectors allow. A short list gives its pairs; a long one a forest, which
joins the same sets with fewer pairs than the list has entries. Lists of frequent
shingles are cut into blocks by their counted frequency before they are dealt
out; sets of one list that lie in different blocks and are not yet joined are
compared after that. So similar sets are always in one candidate group, and each
set goes once to its group, where the sets' elements are compared and the similar
pairs that join two classes come out: again fewer than sets. All steps give rows
in proportion to what they read, and no link between classes is lost. ``linked``
compares all pairs of sets within each class, in blocks, and so gives every
document its whole number of links.

Copies of a set are collapsed by a 64-bit sum of mixed shingle hashes. Nothing
but histograms of bounded size reaches the driver.

Defined results: a null or empty text has an empty set and is linked with
nothing, itself its component; a null id takes part in no component and gets a
null one; repeated rows are copies; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, fresh, met, per_batch, scratch, stored, text_key, utf8
from .components import components
from .hashing import ODD, U, mix, shingles, words

CHUNK = 2 << 20
#: Buckets of the count vectors, whose distance bounds the size of a symmetric difference from below: at least so many, and one for each 8 elements or fewer; so many at most in entries of lists.
BUCKETS = 256
LIST_BUCKETS = 1024
#: Bits of the table of frequent shingles; per task, only buckets far above the mean are reported.
HOT_BITS = 20
#: Lists of so many entries at most give their pairs, longer ones a forest; entries of one block of a list.
SHORT = 8
BLOCK = 4096
#: The boundary is one of these sizes; enumerating a subset costs 1, scanning an entry of an inverted list this much.
BOUNDARIES = (9, 19, 29, 39)
ENTRY_COST = 6.0
#: Sets of one class or group, and elements of them, that one side of a block of pairs holds: for counting links, and for joining classes.
CLASS_SETS = 1024
CLASS_ELEMENTS = 1 << 20
GROUP_SETS = 4096
GROUP_ELEMENTS = 1 << 21


def sets_of(texts: list[bytes], width: int):
    """Per text its sorted distinct shingle hashes, in bounded chunks: (first, until, sets)."""
    for a, b in chunks([len(t) for t in texts], CHUNK):
        yield a, b, shingles(*words(texts[a:b], True), width)


def set_id(s: np.ndarray) -> int:
    """The same for equal sets, whatever the texts."""
    return int(mix(mix(s + ODD[4]).sum(keepdims=True, dtype=np.uint64) * ODD[5] + U(len(s))).view(np.int64)[0])


def vector(s: np.ndarray) -> bytes:
    """Counts of elements by bucket modulo 16, two to a byte."""
    width = max(BUCKETS, 1 << ((len(s) - 1) // 8).bit_length())
    counts = (np.bincount((s >> U(20)) & U(width - 1), minlength=width) & 15).astype(np.uint8)
    return (counts[::2] | counts[1::2] << 4).tobytes()


def vectors(column: list[bytes]) -> np.ndarray:
    """Counts of vectors of one width."""
    packed = np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)
    return np.stack([packed & 15, packed >> 4], 2).reshape(len(column), -1).view(np.int8)


def folded(counts: np.ndarray, width: int) -> np.ndarray:
    """Vectors of a greater width as ones of ``width``."""
    return counts.reshape(len(counts), -1, width).sum(1, dtype=np.int8) & 15


def list_vector(v: bytes) -> bytes:
    """The vector in at most ``LIST_BUCKETS`` buckets."""
    if 2 * len(v) <= LIST_BUCKETS:
        return v
    counts = folded(vectors([v]), LIST_BUCKETS)[0].view(np.uint8)
    return (counts[::2] | counts[1::2] << 4).tobytes()


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At most the sizes of the symmetric differences: numbers are at least as far apart as their remainders are on the circle."""
    apart = np.abs(x - y)
    return np.minimum(apart, 16 - apart).sum(1, dtype=np.int64)


def distances_of(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Of each two vectors, whatever their widths."""
    widths = np.array([[2 * len(x), 2 * len(y)] for x, y in zip(a, b)])
    out = np.zeros(len(a), np.int64)
    for pair in np.unique(widths, axis=0):
        at = np.flatnonzero((widths == pair).all(1))
        for part in np.array_split(at, 1 + len(at) * int(pair.max()) // CHUNK):
            out[part] = distances(*(folded(vectors([c[k] for k in part]), int(pair.min())) for c in (a, b)))
    return out


def least_overlap(n: int, percent: int) -> int:
    """Elements that a set of ``n`` shares at least with any similar one."""
    return -(-percent * n // 100)


def scan_sets(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, ta, n, sid, vec and wide (the vector where it has more buckets than vec) of each row; and rows of kind "hot" (sid: bucket, n: count) for frequent shingles."""

    def run(batches):
        seen = np.zeros(1 << HOT_BITS, np.int64)
        names, kinds = ["doc_id", "ta", "n", "sid", "vec", "wide", "hot"], (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
        for batch in batches:
            n, sid, vec, wide = [], [], [], []
            for _, _, sets in sets_of(utf8(batch), width):
                for s in sets:
                    n.append(len(s))
                    sid.append(set_id(s))
                    v = vector(s) if len(s) else b""
                    vec.append(list_vector(v) or None)
                    wide.append(v if 2 * len(v) > LIST_BUCKETS else None)
                if sets:
                    seen += np.bincount((np.concatenate(sets) >> U(64 - HOT_BITS)).astype(np.int64), minlength=1 << HOT_BITS)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "ta"), *(pa.array(c, k) for c, k in zip((n, sid, vec, wide, [False] * len(n)), kinds[2:]))], names=names)
        mean = seen.mean()
        hot = np.flatnonzero(seen > mean + 4 * mean**0.5 + 4)
        if len(hot):
            nulls = pa.nulls(len(hot), pa.int64())
            yield pa.RecordBatch.from_arrays([nulls, nulls, pa.array(np.minimum(seen[hot], 2**31 - 1).astype(np.int32)), pa.array(hot), pa.nulls(len(hot), pa.binary()), pa.nulls(len(hot), pa.binary()), pa.array(np.ones(len(hot), bool))], names=names)

    return rows.select("doc_id", "ta", "text").mapInArrow(run, "doc_id long, ta long, n int, sid long, vec binary, wide binary, hot boolean")


def subsets(n: int, percent: int) -> int:
    """How many elements a set of ``n`` can miss of what a similar set shares with it."""
    return n - least_overlap(n, percent)


def boundary(histogram: dict[int, int], total_heavy: float, percent: int) -> int:
    """Largest size of light sets, by estimated cost. histogram: sets by size up to the largest choice; total_heavy: list entries of larger sets."""
    def cost(x: int) -> float:
        light = sum(c * sum(comb(n, a) for a in range(subsets(n, percent) + 1)) for n, c in histogram.items() if n <= x)
        heavy = sum(c * (n - least_overlap(n, percent) + 1) for n, c in histogram.items() if 100 * n > percent * x)
        return light + ENTRY_COST * (heavy + total_heavy)

    return min(BOUNDARIES, key=lambda x: (cost(x), x))


LISTS = "kind byte, key long, block int, sid long, n int, at int"
NAMES = [f.split()[0] for f in LISTS.split(", ")]


def blocks_of(hot: dict[int, int]) -> np.ndarray:
    """By bucket, the number of blocks of its shingles' lists."""
    out = np.ones(1 << HOT_BITS, np.int32)
    for bucket, count in hot.items():
        out[bucket] = -(-count // BLOCK)
    return out


def postings(rows: DataFrame, width: int, percent: int, light: int, hot: dict[int, int]) -> DataFrame:
    """Entries of inverted lists (kind 0: token, block, sid, n, position) and subsets of light sets (kind 1: hash, 0, sid, size of the subset, elements missed).

    A set's entries are given once per task, however many copies it has.
    """
    rank = np.zeros(1 << HOT_BITS, np.uint16)
    for bucket, count in hot.items():
        rank[bucket] = min(count, (1 << 16) - 1)
    blocks = blocks_of(hot)

    def run(batches):
        given: set[int] = set()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in NAMES]

            def add(kind: int, key: np.ndarray, block: np.ndarray, sid: int, n, at) -> None:
                for c, v in zip(parts, (np.full(len(key), kind, np.int8), key.view(np.int64), block.astype(np.int32), np.full(len(key), sid, np.int64), np.broadcast_to(np.int32(n), len(key)), np.asarray(at, np.int32))):
                    c.append(v)

            for _, _, sets in sets_of(utf8(batch), width):
                for s in sets:
                    n = len(s)
                    sid = set_id(s)
                    if not n or sid in given:
                        continue
                    given.add(sid)
                    if n <= light:
                        for missed in range(subsets(n, percent) + 1):
                            mixed = mix(s + ODD[4])
                            out = np.array(list(combinations(range(n), missed)), np.int64).reshape(comb(n, missed), missed)
                            keys = mixed.sum(keepdims=True, dtype=np.uint64) - mixed[out].sum(1, dtype=np.uint64)
                            add(1, mix(keys * ODD[5] + U(n - missed)), np.zeros(len(keys)), sid, n - missed, np.full(len(keys), missed))
                    if 100 * n > percent * light:
                        order = np.argsort(rank[(s >> U(64 - HOT_BITS)).astype(np.int64)].astype(np.uint64) << U(48) | (s & U((1 << 48) - 1)), kind="stable")
                        p = n - least_overlap(n, percent) + 1
                        block = (sid & 0x7FFFFFFF) % blocks[(s[order[:p]] >> U(64 - HOT_BITS)).astype(np.int64)]
                        add(0, s[order[:p]], block, sid, n, np.arange(p))
            if parts[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in parts], names=NAMES)

    return rows.select("text").mapInArrow(run, LISTS)


def may_match(n, m, i, j, percent: int):
    """Sets of ``n`` and ``m`` elements whose first common shingle is at positions ``i`` and ``j`` can be similar."""
    return np.minimum(n - i, m - j) * (100 + percent) >= (n + m) * percent


def scan_lists(given: DataFrame, percent: int, blocks: np.ndarray) -> DataFrame:
    """What the lists leave, as ``LISTS``: entries of subsets that several sets share (kind 1), pairs of short lists (kind 2; key and sid: the sets) and entries of long lists (kind 0).

    A task holds no more of a list than makes it a long one.
    """

    def run(batches):
        held = [np.zeros(0, t) for t in (np.int8, np.int64, np.int32, np.int64, np.int32, np.int32)]
        last = out_id = None  # the last row; the list whose first entries have gone out
        for batch in batches:
            rows = [column(batch, c).to_numpy() for c in NAMES]
            if not len(rows[0]):
                continue
            again = np.ones(len(rows[0]), bool)  # tasks may each have given a set's entries
            for c in rows[:4]:
                again[1:] &= c[1:] == c[:-1]
            again[0] = last == tuple(c[0] for c in rows[:4])
            last = tuple(c[-1] for c in rows[:4])
            rows = [np.concatenate([h, c[~again]]) for h, c in zip(held, rows)]
            if len(rows[0]):
                found, held, out_id = _lists(rows, out_id, percent, blocks, False)
                yield from found
        if len(held[0]):
            yield from _lists(held, out_id, percent, blocks, True)[0]

    return given.repartition("kind", "key", "block").sortWithinPartitions("kind", "key", "block", "sid").mapInArrow(run, LISTS)


def _lists(rows: list[np.ndarray], out_id, percent: int, blocks: np.ndarray, ended: bool):
    """(batches, rows to hold, list that goes out as it comes) of sorted rows; only the last list may go on, and the first may have gone out in part."""
    kind, key, block, sid, n, at = rows
    new = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (key[1:] != key[:-1]) | (block[1:] != block[:-1])]))
    size = np.diff(np.append(new, len(key)))
    cut = blocks[(key[new].view(np.uint64) >> U(64 - HOT_BITS)).astype(np.int64)] > 1
    out = np.where(kind[new] == 1, size > 1, (size > SHORT) | cut)
    if out_id == (kind[0], key[0], block[0]):
        out[0] = True
    pairs = ~out & (size > 1)
    hold = slice(len(key), None)
    goes_on = None
    if not ended:
        if out[-1]:
            goes_on = (kind[-1], key[-1], block[-1])
        else:
            pairs[-1], hold = False, slice(new[-1], None)
    found = []
    if out.any():
        whole = np.repeat(out, size)
        found.append(pa.RecordBatch.from_arrays([pa.array(c[whole]) for c in rows], names=NAMES))
    if pairs.any():
        group = np.repeat(np.arange(len(new)), size)
        x = np.flatnonzero(np.repeat(pairs, size))
        a, b = [], []
        for d in range(1, SHORT):
            x = x[x + d < len(key)]
            x = x[group[x] == group[x + d]]
            y = x + d
            p = may_match(n[x], n[y], at[x], at[y], percent)
            a.append(np.maximum(sid[x[p]], sid[y[p]]))
            b.append(np.minimum(sid[x[p]], sid[y[p]]))
        both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        zero = np.zeros(len(both), np.int32)
        found.append(pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(both), 2, np.int8), both[:, 0].copy(), zero, both[:, 1].copy(), zero, zero)], names=NAMES))
    return found, [c[hold] for c in rows], goes_on


def vector_filter(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose count vectors don't rule them out."""
    va, vb = (reps.select(F.col("sid").alias(x), F.coalesce("wide", "vec").alias(f"vec_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        apart = distances_of(*(column(batch, c).to_pylist() for c in ("vec_a", "vec_b")))
        total = column(batch, "n_a").to_numpy().astype(np.int64) + column(batch, "n_b").to_numpy()
        keep = pa.array(may_differ(apart, total, percent))
        return pa.RecordBatch.from_arrays([column(batch, c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return pairs.join(va, "a").join(vb, "b").mapInArrow(per_batch(run), "a long, b long")


def may_differ(distance: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """A symmetric difference of at least ``distance`` in sets of ``total`` elements together leaves enough in common."""
    return distance * (100 + percent) <= total * (100 - percent)


def forest_of_lists(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that join the sets of each list, or part of one, that sizes, positions and vectors allow to be similar.

    entries: key, i, j (which part), sid, n, at, component, vec; sets of one component are joined already.
    """

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            marks = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
            new = np.flatnonzero(np.concatenate([[True], (marks[:, 1:] != marks[:, :-1]).any(0)]))
            rest = table.slice(new[-1]).combine_chunks()
            yield _forests(table, new, percent)
        if rest is not None and rest.num_rows:
            yield _forests(rest, np.array([0, rest.num_rows]), percent)

    dealt = entries.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "sid")
    return dealt.select("key", "i", "j", "sid", "n", "at", "component", "vec").mapInArrow(run, "a long, b long")


def _forests(table: pa.Table, new: np.ndarray, percent: int) -> pa.RecordBatch:
    """Of the lists that begin at ``new``, but for the last."""
    sid, n, at, component = (table.column(c).to_numpy().astype(np.int64) for c in ("sid", "n", "at", "component"))
    vec = table.column("vec")
    found = [_forest(*(c[a:b] for c in (sid, n, at, component)), vec.slice(a, b - a), percent) for a, b in zip(new[:-1].tolist(), new[1:].tolist())]
    found = np.concatenate([np.zeros((0, 2), np.int64), *(f for f in found if len(f))])
    found = np.unique(np.stack([found.max(1), found.min(1)], 1), axis=0) if len(found) else found
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["a", "b"])


def _forest(sid: np.ndarray, n: np.ndarray, at: np.ndarray, component: np.ndarray, vec: pa.ChunkedArray, percent: int) -> np.ndarray:
    label = np.unique(component, return_inverse=True)[1]
    left = int(label.max()) + 1
    if left < 2:
        return np.zeros((0, 2), np.int64)
    vec = vec.to_pylist()
    width = np.array([2 * len(v) for v in vec])
    own = {w: vectors([v for v, x in zip(vec, width) if x == w]) for w in np.unique(width).tolist()}
    half = {w: folded(c, w // 2) for w, c in own.items()}
    first_of = {w: int(np.searchsorted(width, w)) for w in own}  # sizes rise, and so do widths

    def apart(x: int, y: np.ndarray) -> np.ndarray:
        """A set of at most twice the size has a vector of at most twice the width."""
        w = int(width[x])
        mine = own[w][x - first_of[w]]
        out = np.zeros(len(y), np.int64)
        for wide, known in ((w, own), (2 * w, half)):
            at = width[y] == wide
            if at.any():
                out[at] = distances(mine, known[wide][y[at] - first_of[wide]])
        return out

    until = np.searchsorted(n, 100 * n // percent, "right")  # larger ones can't be similar
    out = []
    for x in range(len(n) - 1):
        y = x + 1 + np.flatnonzero(label[x + 1 : until[x]] != label[x])
        y = y[may_match(n[x], n[y], at[x], at[y], percent)]
        if len(y):
            y = y[may_differ(apart(x, y), n[x] + n[y], percent)]
        if len(y):
            labels, first = np.unique(label[y], return_index=True)
            out.append(np.stack([np.full(len(first), sid[x]), sid[y[first]]], 1))
            label[np.isin(label, labels)] = label[x]
            left -= len(labels)
            if left == 1:
                break
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def across_blocks(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Parts of the lists that have several components in several blocks, as ``forest_of_lists`` takes them.

    A list's largest component is not compared with itself: its entries stay
    in their block, and the others come to every block.
    """
    entries = entries.join(classes.select(F.col("node").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    sizes = entries.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), F.min("block").alias("lo"), F.max("block").alias("hi"))
    lists = sizes.groupBy("key").agg(F.max(F.struct("c", "component")).alias("most"), F.sum("c").alias("k"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    number = lambda c: F.ceil(c / BLOCK).cast("int")
    lists = lists.where((F.col("most.c") < F.col("k")) & (F.col("lo") < F.col("hi"))).select("key", F.col("most.component").alias("most"), number(F.col("k")).alias("blocks"), number(F.col("k") - F.col("most.c")).alias("others"))
    entries = entries.join(lists, "key").withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")).withColumn("other", F.pmod(F.xxhash64("sid"), F.col("others")).cast("int"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    place = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    stay = F.transform(upto("others"), lambda j: place(F.col("own"), j))
    come = F.concat(F.transform(upto("blocks"), lambda i: place(i, F.col("other"))), F.transform(upto("others"), lambda j: place(-1 - F.least(j, F.col("other")), F.greatest(j, F.col("other")))))
    return entries.withColumn("to", F.explode(F.when(F.col("component") == F.col("most"), stay).otherwise(come))).select("key", "to.i", "to.j", "sid", "n", "at", "component")


def dealt_sets(rows: DataFrame, wanted: DataFrame, width: int, most_sets: int, most_elements: int) -> DataFrame:
    """The sets (made: their elements) of the classes in ``wanted``, dealt out in pairs of blocks of their class and sorted by size.

    wanted: sid, doc_id and ta of one row that has the set, n, copies, component; rows: doc_id, ta, text.
    """
    sizes = wanted.groupBy("component").agg(F.greatest(F.ceil(F.count(F.lit(1)) / most_sets), F.ceil(F.sum(F.col("n").cast("long")) / most_elements)).cast("int").alias("blocks"))
    wanted = stored(wanted.join(sizes, "component").select("doc_id", "ta", "sid", "copies", "component", "blocks"), "class-sets")
    names, kinds = ["component", "blocks", "sid", "copies", "n", "made"], (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())

    def send(batches):
        given: set[int] = set()  # repeated rows give their sets once per task
        for batch in batches:
            fixed = [column(batch, c).to_pylist() for c in names[:4]]
            for first, until, sets in sets_of(utf8(batch), width):
                made = []
                for k, s in zip(range(first, until), sets):
                    if fixed[2][k] not in given:
                        given.add(fixed[2][k])
                        made.append((*(c[k] for c in fixed), len(s), s.tobytes()))
                for k, m in chunks([len(r[5]) for r in made], 4 * CHUNK):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made[k:m]), kinds)], names=names)

    texts, _ = met(rows, wanted, "ta")
    sent = texts.join(wanted, ["doc_id", "ta"]).select(*names[:4], "text").mapInArrow(send, "component long, blocks int, sid long, copies long, n int, made binary")
    sent = sent.withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "n", "sid", "copies", "made")
    return sent.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "n", "sid")


def dealt_groups(batches):
    """The groups that ``dealt_sets`` deals out: whether pairs are across two blocks only, and own, sid, copies and elements of each set by rising size."""
    at, group = (0, 0, 0), []
    for batch in batches:
        for c, i, j, *entry in zip(*(column(batch, c).to_pylist() for c in ("component", "i", "j", "own", "sid", "copies", "made"))):
            if (c, i, j) != at:
                yield at[1] != at[2], group
                at, group = (c, i, j), []
            if not group or group[-1][1] != entry[1]:  # tasks may each have given the set of a repeated row
                group.append(entry)
    yield at[1] != at[2], group


def joining_pairs(rows: DataFrame, wanted: DataFrame, width: int, percent: int) -> DataFrame:
    """Similar pairs (a, b) that join the classes in each group of ``wanted``."""

    def compare(batches):
        for across, group in dealt_groups(batches):
            if len(group) > 1:
                found = _join_sets(group, across, percent)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return dealt_sets(rows, wanted, width, GROUP_SETS, GROUP_ELEMENTS).mapInArrow(compare, "a long, b long")


class _Sets:
    """The sets of one group by rising size, their elements as numbers; ``shared`` compares one with some that follow."""

    def __init__(self, group: list):
        self.own, self.sid, self.copies = (np.array([g[k] for g in group]) for k in range(3))
        sets = [np.frombuffer(g[3], np.uint64) for g in group]
        self.n = np.array([len(s) for s in sets])
        self.offsets = np.concatenate([[0], np.cumsum(self.n)])
        distinct, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(distinct), np.uint8)

    def similar(self, x: int, y: np.ndarray, percent: int) -> np.ndarray:
        """Of ``y``, those that are similar to ``x``."""
        mine = self.flat[self.offsets[x] : self.offsets[x + 1]]
        self.mark[mine] = 1
        n = self.n[y]
        starts = np.cumsum(n) - n
        place = np.arange(int(n.sum())) + np.repeat(self.offsets[y] - starts, n)
        both = np.add.reduceat(self.mark[self.flat[place]], starts, dtype=np.int64)
        self.mark[mine] = 0
        return y[100 * both >= percent * (self.n[x] + n - both)]


def _join_sets(group: list, across: bool, percent: int) -> list[tuple[int, int]]:
    """Similar pairs of one group, or of its two blocks, that make one component of two."""
    sets = _Sets(group)
    label = np.arange(len(group))
    until = np.searchsorted(sets.n, 100 * sets.n // percent, "right")  # larger ones can't be similar
    out = []
    for x in range(len(group) - 1):
        y = x + 1 + np.flatnonzero(label[x + 1 : until[x]] != label[x])
        if across:
            y = y[sets.own[y] != sets.own[x]]
        if len(y):
            y = sets.similar(x, y, percent)
        if len(y):
            labels, first = np.unique(label[y], return_index=True)
            out += [(int(sets.sid[x]), int(sets.sid[k])) for k in y[first]]
            label[np.isin(label, labels)] = label[x]
    return out


def similar(docs: DataFrame, width: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """(members, classes): members has doc_id, ta, n and sid of each row; classes sid and component (a sid) of each set that is linked."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", text_key()[0].alias("ta"), "text")
    scanned = stored(scan_sets(rows, width), "sets-scan")
    members = scanned.where("not hot").select("doc_id", "ta", "n", "sid")
    hot = {r[0]: r[1] for r in scanned.where("hot").groupBy("sid").agg(F.sum("n")).collect()}  # at most 2**HOT_BITS rows
    some = scanned.where("not hot and n > 0 and doc_id is not null")
    top = max(BOUNDARIES)
    reps = some.groupBy("sid").agg(F.min(F.struct("doc_id", "ta")).alias("r"), F.first("n").alias("n"), F.first("vec").alias("vec"), F.first("wide").alias("wide")).select("sid", "r.doc_id", "r.ta", "n", "vec", "wide")
    reps = stored(reps, "reps")
    entries = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    counted = reps.groupBy(F.least("n", F.lit(top + 1)).alias("n")).agg(F.count(F.lit(1)).alias("c"), F.sum(entries).alias("e")).collect()
    light = boundary({r.n: r.c for r in counted if r.n <= top}, float(sum(r.e for r in counted if r.n > top)), percent)

    blocks = blocks_of(hot)
    given = stored(scan_lists(postings(rows.where("doc_id is not null"), width, percent, light, hot), percent, blocks), "lists")

    # Light sets: a star around the one that misses least, for each subset.
    subset = given.where("kind = 1")
    star = subset.groupBy("key").agg(F.min(F.struct("at", "sid")).alias("l"))
    both = (F.col("at") + F.col("l.at")) * percent <= F.col("n") * (100 - percent)
    edges = subset.join(star, "key").where(both & (F.col("sid") != F.col("l.sid"))).select(F.col("sid").alias("a"), F.col("l.sid").alias("b"))

    # Heavy sets: candidates from the lists, groups of them, and the similar pairs that join classes in each group.
    near = vector_filter(given.where("kind = 2").select(F.col("key").alias("a"), F.col("sid").alias("b")).distinct(), reps, percent)
    entries = given.where("kind = 0").select("key", "block", "sid", "n", "at")
    vecs = reps.select("sid", "vec")
    alone = entries.select("key", F.col("block").alias("i"), F.lit(0).alias("j"), "sid", "n", "at", F.col("sid").alias("component"))
    pairs = stored(near.unionByName(forest_of_lists(alone.join(vecs, "sid"), percent)), "pairs")
    groups = stored(components(pairs), "groups")
    if blocks.max() > 1:
        more = stored(forest_of_lists(across_blocks(entries, groups).join(vecs, "sid"), percent), "pairs-across")
        if more.limit(1).count():
            groups = stored(components(pairs.unionByName(more)), "groups")
    wanted = reps.join(groups.select(F.col("node").alias("sid"), "component"), "sid").select("sid", "doc_id", "ta", "n", F.lit(1).cast("long").alias("copies"), "component")
    edges = stored(joining_pairs(rows, wanted, width, percent).unionByName(edges), "edges")
    return members, stored(components(edges), "classes", keep=True)


def labelled(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, ta, n_shingles, component_id of each row, and first_ta: with component_id the first row of the component."""
    with scratch(docs.sparkSession):
        return stored(_label(*similar(docs, width, percent)).drop("sid"), "labelled", keep=True)


def _label(members: DataFrame, classes: DataFrame) -> DataFrame:
    of_set = members.where("n > 0 and doc_id is not null").groupBy("sid").agg(F.min(F.struct("doc_id", "ta")).alias("least"))
    linked = of_set.join(classes.select(F.col("node").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    of_class = linked.groupBy("component").agg(F.min("least").alias("first"))
    label = linked.join(of_class, "component").select("sid", "first")
    alone = F.struct("doc_id", "ta")
    first = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("first")).otherwise(alone)
    out = members.join(label, "sid", "left").withColumn("first", first)
    return out.select("doc_id", "ta", F.col("n").cast("long").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), F.col("first.ta").alias("first_ta"), "sid")


def digest(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of each document."""
    return labelled(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def links_of_sets(docs: DataFrame, members: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """sid, links: the rows with another set that is similar, for every set that has such rows.

    Similar sets are of one class, so all pairs of a class are compared, by their
    elements. A large class is cut into blocks by hash; a task holds two at a time.
    """
    reps = members.where("n > 0 and doc_id is not null").groupBy("sid").agg(F.min(F.struct("doc_id", "ta")).alias("r"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    wanted = reps.join(classes.select(F.col("node").alias("sid"), "component"), "sid").select("sid", "r.doc_id", "r.ta", "n", "copies", "component")

    def compare(batches):
        for across, group in dealt_groups(batches):
            found = _count_links(group, across, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["sid", "links"])

    return dealt_sets(docs, wanted, width, CLASS_SETS, CLASS_ELEMENTS).mapInArrow(compare, "sid long, links long").groupBy("sid").agg(F.sum("links").alias("links"))


def _count_links(group: list, across: bool, percent: int) -> dict[int, int]:
    """Rows linked to each set by the pairs of one group, or by those of different blocks."""
    if len(group) < 2:
        return {}
    sets = _Sets(group)
    until = np.searchsorted(sets.n, 100 * sets.n // percent, "right")  # larger ones can't be similar
    links = np.zeros(len(group), np.int64)
    for x in range(len(group) - 1):
        y = np.arange(x + 1, until[x])
        if across:
            y = y[sets.own[y] != sets.own[x]]
        if len(y):
            y = sets.similar(x, y, percent)
            links[x] += sets.copies[y].sum()
            links[y] += sets.copies[x]
    return {int(s): int(c) for s, c in zip(sets.sid, links) if c}


def linked(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id as ``digest``, and n_links: how many other rows each is similar to, copies included.

    A row with an empty set or a null id has no links and is none.
    """
    with scratch(docs.sparkSession):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", text_key()[0].alias("ta"), "text")
        members, classes = similar(docs, width, percent)
        found = links_of_sets(rows, members, classes, width, percent)
        copies = members.where("n > 0 and doc_id is not null").groupBy("sid").agg((F.count(F.lit(1)) - 1).alias("copies"))
        each = _label(members, classes).join(copies.join(found, "sid", "left"), "sid", "left")
        n_links = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("copies") + F.coalesce("links", F.lit(0))).otherwise(0)
        return stored(each.select("doc_id", "n_shingles", "component_id", n_links.cast("long").alias("n_links")), "linked", keep=True)


def keep_one(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with all their columns; of repeated rows one stays.

    Rows with an empty set or a null id all stay.
    """
    marked = labelled(docs, width, percent).where("doc_id is not null and n_shingles > 0")
    gone = marked.where("component_id <> doc_id or first_ta <> ta").select("doc_id", "ta").distinct()
    again = marked.where("component_id = doc_id and first_ta = ta").groupBy("doc_id", "ta").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id", "ta")
    id_, ta, more = fresh(docs, "_doc", "_ta", "_again")
    special = stored(gone.withColumn(more, F.lit(False)).unionByName(again.withColumn(more, F.lit(True))).withColumnsRenamed({"doc_id": id_, "ta": ta}), "special", keep=True)
    maybe, never = met(docs.withColumn(id_, F.col("doc_id").cast("long")).withColumn(ta, text_key()[0]), special, ta)
    found = maybe.join(special, [id_, ta], "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = never.select(*columns).unionByName(found.where(F.col(more).isNull()).select(*columns))
    if special.where(more).limit(1).count():
        out = out.unionByName(found.where(more).dropDuplicates([id_, ta]).select(*columns))
    return out
