import random

import numpy as np
import pytest

from shruti.llm import near_copies as nc
from shruti.llm.components import components

from .corpora import clashing, documents, plain, unharmed


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def by_force(rows, k, percent):
    """doc_id -> (n_shingles, component)."""
    sets = [(i, shingle_set(t, k)) for i, t, *_ in rows]
    real = [(i, s) for i, s in sets if s and i is not None]
    parent = {i: i for i, _ in real}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(real):
        for j, t in real[:a]:
            o = len(s & t)
            if 100 * o >= percent * (len(s) + len(t) - o):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [(i, len(s), find(i) if s and i is not None else i) for i, s in sets]


def drift(seed, n, words, changes):
    """Many copies of one text that drift apart, so that only some pairs are similar."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randrange(changes + 1)):
            copy[r.randrange(words)] = f"v{r.randrange(50)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_digest(spark, k, percent):
    df, rows = documents(spark)
    out = nc.digest(clashing(df), k, percent)
    want = by_force(rows, k, percent)
    assert plain(out, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert len({c for _, _, c in want}) < len(want) - 15


@pytest.mark.parametrize("words,changes,percent", [(14, 1, 90), (24, 3, 90), (45, 4, 90), (120, 5, 90), (60, 6, 80)])
def test_long_lists(spark, words, changes, percent):
    rows = [(i, t) for i, t in enumerate(drift(words, 80, words, changes))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert plain(nc.digest(df, 3, percent), "doc_id", "n_shingles", "component_id") == sorted(by_force(rows, 3, percent), key=repr)


@pytest.mark.parametrize("block", [3, 7, 40])
@pytest.mark.parametrize("changes", [5, 12])
def test_lists_of_several_blocks(spark, monkeypatch, block, changes):
    monkeypatch.setattr(nc, "BLOCK", block)
    rows = [(i, t) for i, t in enumerate(drift(9, 60, 80, changes))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert plain(nc.digest(df), "doc_id", "n_shingles", "component_id") == sorted(by_force(rows, 3, 90), key=repr)


def outliers(seed):
    """Sets close to one another, in two halves of which only some pairs across are similar, and planted outliers of one half only."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    far = [*base[:100], *(f"u{i}" for i in range(20))]
    out = [" ".join(w if k != j else f"x{j}" for k, w in enumerate(r.choice([base, far]))) for j in range(60)]
    return out + [" ".join([*far[: 120 - d], *(f"y{d}{i}" for i in range(d))]) for d in (1, 2, 4, 6, 9, 12)]


@pytest.mark.parametrize("sets,elements,block,percent", [(4096, 1 << 21, 4096, 90), (7, 1 << 21, 9, 90), (4096, 900, 20, 80)])
def test_groups_of_several_blocks(spark, monkeypatch, sets, elements, block, percent):
    for name, value in (("GROUP_SETS", sets), ("GROUP_ELEMENTS", elements), ("BLOCK", block)):
        monkeypatch.setattr(nc, name, value)
    rows = [(i, t) for i, t in enumerate(outliers(sets))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert plain(nc.digest(df, 3, percent), "doc_id", "n_shingles", "component_id") == sorted(by_force(rows, 3, percent), key=repr)


def test_lists_over_many_small_batches(spark):
    rows = [(i, t) for i, t in enumerate(drift(9, 60, 80, 5) + drift(8, 30, 12, 1))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert plain(nc.digest(df), "doc_id", "n_shingles", "component_id") == sorted(by_force(rows, 3, 90), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_rows_stay_in_proportion():
    """Of n sets that all may match, n - 1 pairs come out, whatever the list's length."""
    sets = [np.arange(300, dtype=np.uint64) * nc.ODD[0] for _ in range(200)]
    vec = nc.pa.chunked_array([nc.pa.array([nc.vector(s) for s in sets])])
    found = nc._forest(np.arange(200), np.full(200, 300), np.zeros(200, np.int64), np.arange(200), vec, 90)
    assert len(found) == 199
    pairs = nc._join_sets([(0, k, 1, np.sort(s).tobytes()) for k, s in enumerate(sets)], False, 90)
    assert len(pairs) == 199


def links_by_force(rows, k, percent):
    """One (doc_id, number of linked rows) per row."""
    sets = [(i, shingle_set(t, k)) for i, t, *_ in rows]
    like = lambda s, t: s and t and 100 * len(s & t) >= percent * len(s | t)
    return sorted(((i, sum(1 for b, (j, t) in enumerate(sets) if a != b and None not in (i, j) and like(s, t))) for a, (i, s) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("blocks", [(1024, 1 << 20), (7, 1 << 20), (1024, 500)])
def test_no_link_is_lost(spark, monkeypatch, blocks):
    monkeypatch.setattr(nc, "CLASS_SETS", blocks[0])
    monkeypatch.setattr(nc, "CLASS_ELEMENTS", blocks[1])
    rows = [(i, t) for i, t in enumerate(drift(3, 60, 80, 3))] + [(1000 + i, f"{t} X") for i, t in enumerate(drift(4, 40, 14, 1))]
    rows += [rows[0], rows[0], (None, rows[1][1]), (2000, None), (2001, ""), (2002, rows[2][1].upper())]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = nc.linked(df)
    assert plain(got, "doc_id", "n_links") == links_by_force(rows, 3, 90)
    assert plain(got, "doc_id", "n_shingles", "component_id") == sorted(by_force(rows, 3, 90), key=repr)
    # within a group whose pairs are all similar, every pair counts, not only a tree of them
    assert sum(n for _, n in plain(got, "doc_id", "n_links")) > 2 * len(rows)
    assert nc.linked(df.limit(0)).count() == 0


def test_keep_one(spark):
    df, rows = documents(spark, 3)
    want = {(i, c) for i, n, c in by_force(rows, 5, 80) if n and i is not None}
    kept = nc.keep_one(clashing(df), 5, 80)
    assert kept.columns == clashing(df).columns and unharmed(kept)
    got = kept.collect()
    with_words = sorted(r.doc_id for r in got if r.doc_id is not None and (r.text or "").split())
    assert with_words == sorted({c for _, c in want})
    rest = [r for r in rows if r[0] is None or not (r[1] or "").split()]
    assert len(got) == len(with_words) + len(rest)


@pytest.mark.parametrize("n", range(1, 7))
def test_few_words_alone_in_a_chunk(n):
    text = b" ".join([b"a", b"b", b"c", b"d", b"e", b"f"][:n])
    (alone,) = nc.shingles(*nc.words([text], True), 5)
    beside, _ = nc.shingles(*nc.words([text, b"x " * 20], True), 5)
    assert alone.tolist() == beside.tolist() and len(alone) == max(1, n - 4)


def test_keep_one_of_three_words(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert plain(nc.keep_one(df, 5, 80), "doc_id", "text") == [(1, "a b c")]


def test_empty_table(spark):
    df, _ = documents(spark)
    assert nc.digest(df.limit(0)).count() == 0 and nc.keep_one(df.limit(0), 5, 80).count() == 0


def test_boundary_follows_the_cost():
    assert nc.boundary({10: 10}, 0.0, 90) >= 19
    assert nc.boundary({39: 10**6}, 0.0, 90) < 39


def test_vectors_bound_the_difference():
    r = np.random.default_rng(1)
    for _ in range(100):
        a, b = (np.unique(r.integers(0, 1 << 63, 300, dtype=np.uint64)[: r.integers(1, 300)]) for _ in "ab")
        a = np.unique(np.concatenate([a, r.integers(0, 1 << 63, r.choice([0, 0, 9000]), dtype=np.uint64)]))
        b = np.union1d(b, a[: r.integers(0, len(a) + 1)])
        differ = len(np.setxor1d(a, b))
        for f in (nc.vector, lambda s: nc.list_vector(nc.vector(s))):
            assert nc.distances_of([f(a)], [f(b)])[0] <= differ
            assert nc.distances_of([f(a), f(a)], [f(a), f(b)])[0] == 0


@pytest.mark.parametrize("n", [300, 2000, 5000, 20_000])
def test_vectors_tell_unrelated_sets_apart(n):
    r = np.random.default_rng(n)
    a, b = (np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in "ab")
    like = np.union1d(a[n // 40 :], b[: n // 40])
    far, near = nc.distances_of([nc.vector(a)] * 2, [nc.vector(b), nc.vector(like)])
    assert not nc.may_differ(far, 2 * n, 80) and nc.may_differ(near, 2 * n, 80)


def test_forest_of_sets_of_several_widths():
    r = np.random.default_rng(5)
    whole = np.unique(r.integers(0, 1 << 63, 2600, dtype=np.uint64))
    sets = [whole[:n] for n in (1900, 2040, 2060, 2280, 2500, 2600)]
    vec = nc.pa.chunked_array([nc.pa.array([nc.list_vector(nc.vector(s)) for s in sets])])
    n = np.array([len(s) for s in sets])
    assert len({len(v) for v in vec.to_pylist()}) == 2
    assert len(nc._forest(np.arange(6), n, np.zeros(6, np.int64), np.arange(6), vec, 90)) == 5


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def least(x):
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        return min(seen)

    got = {row.node: row.component for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: least(x) for x in near if near[x] - {x}}
