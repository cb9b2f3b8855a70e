import hashlib
import random

import numpy as np
import pytest

from shruti.llm import common
from shruti.llm import repeats as rp
from shruti.llm.fm_index import FMIndex, WaveletMatrix, suffix_order

from .corpora import clashing, documents, plain


def covered(rows, size):
    """Per row its words and the set of word positions to remove."""
    least = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in split:
        if i is not None:
            for j in range(len(w) - size + 1):
                k = tuple(w[j : j + size])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for j in range(len(w) - size + 1):
                if least[tuple(w[j : j + size])] < i:
                    gone.update(range(j, j + size))
        out.append((i, w, gone))
    return out


def want_digest(rows, size):
    return sorted(((i, len(w), len(g), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in g)).hexdigest()) for i, w, g in covered(rows, size)), key=repr)


COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("size", [50, 33])
@pytest.mark.parametrize("method", [rp.fm_index, rp.sparse_suffixes])
def test_removed(spark, size, method):
    df, rows = documents(spark)
    want = want_digest(rows, size)
    assert plain(rp.removed(clashing(df), method, size), *COLUMNS) == want
    assert sum(w[2] > 0 for w in want) > 10


def passages(seed):
    """Passages of 40 to 90 words in many surroundings, and texts of few words over and over."""
    r = random.Random(seed)
    word = lambda: f"{r.choice('abcdefgh')}{r.randrange(400)}"
    some = [[word() for _ in range(r.choice([40, 50, 51, 60, 90]))] for _ in range(6)]
    out = []
    for _ in range(70):
        parts = []
        for _ in range(r.randrange(1, 4)):
            p = r.choice(some)
            a = r.choice([0, 0, 3, 20])
            parts += [[word() for _ in range(r.randrange(30))], p[a:]]
        out.append(" ".join(w for p in parts for w in p))
    return out + ["go " * 300, "go " * 120 + "stop", "la la ti " * 50, "ti la la " * 50]


@pytest.mark.parametrize("many", [1000, 3])
def test_much_repeated_anchors(spark, monkeypatch, many):
    monkeypatch.setattr(rp, "MANY", many)
    monkeypatch.setattr(rp, "SHARD_WORDS", 2000)
    rows = list(enumerate(passages(many)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = want_digest(rows, 50)
    for method in (rp.fm_index, rp.sparse_suffixes):
        assert plain(rp.removed(df, method), *COLUMNS) == want


def test_with_a_full_filter(spark, monkeypatch):
    monkeypatch.setattr(common, "FILTER_WORDS", 1)
    monkeypatch.setattr(rp, "MANY", 3)
    rows = list(enumerate(passages(5)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert plain(rp.digest(df), *COLUMNS) == want_digest(rows, 50)


def test_spans(spark):
    rows = list(enumerate(passages(8)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {}
    for r in rp.spans(df).collect():
        assert r.first_doc_id < r.doc_id and r.n_words == r.end_word - r.start_word >= 50
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert got == {i: g for i, _, g in covered(rows, 50) if g}


def test_kept_text(spark):
    df = spark.createDataFrame([(1, "a " * 60 + "b"), (2, "x  y\n" + "a " * 55 + "end")], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in rp.removed(df, with_text=True).collect()}
    assert kept == {1: "a " * 60 + "b", 2: "x y end"}


def test_empty_table(spark):
    df, _ = documents(spark)
    assert rp.digest(df.limit(0)).count() == 0 and rp.spans(df.limit(0)).count() == 0


def test_sliding_least():
    r = np.random.default_rng(3)
    for width in (1, 2, 5, 35):
        v = r.integers(0, 6, 200)
        assert rp.sliding_least(v, width).tolist() == [i + int(v[i : i + width].argmin()) for i in range(200 - width + 1)]


def test_suffix_order():
    r = random.Random(1)
    for _ in range(40):
        text = [r.randrange(3) for _ in range(r.randrange(60))]
        assert suffix_order(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_fm_index_counts_patterns():
    r = random.Random(2)
    for n_symbols in (2, 5, 40):
        text = [r.randrange(1, n_symbols) for _ in range(500)] + [0]
        index = FMIndex(np.array(text, np.int64), n_symbols)
        for _ in range(50):
            a = r.randrange(490)
            p = text[a : a + r.randrange(1, 8)]
            lo, hi = index.first[p[-1:]], index.first[np.array(p[-1:]) + 1]
            for s in reversed(p[:-1]):
                lo, hi = index.extend(np.array([s]), lo, hi)
            assert sorted(index.order[lo[0] : hi[0]].tolist()) == [i for i in range(len(text)) if text[i : i + len(p)] == p]


@pytest.mark.parametrize("n_symbols,limit", [(2, 7), (4, 3), (30, 50)])
def test_matching_statistics(n_symbols, limit):
    r = random.Random(limit)
    part = [r.randrange(1, n_symbols) for _ in range(60)]
    text = [r.randrange(1, n_symbols) for _ in range(120)] + part + [r.randrange(1, n_symbols) for _ in range(70)] + part + [0]
    index = FMIndex(np.array(text, np.int64), n_symbols)
    ends = np.arange(limit, len(text))
    length, lo, hi = index.statistics(np.array(text, np.int64), ends, limit)
    for e, n, a, b in zip(ends.tolist(), length.tolist(), lo.tolist(), hi.tolist()):
        where = lambda k: [i for i in range(len(text) - k + 1) if text[i : i + k] == text[e - k : e]]
        assert n == max([0, *(k for k in range(1, limit + 1) if len(where(k)) > 1)])
        assert not n or sorted(index.order[a:b].tolist()) == where(n)
    assert limit < 50 or max(length) == 50


def test_wavelet_matrix_ranks():
    r = np.random.default_rng(4)
    values = r.integers(0, 13, 1000)
    matrix = WaveletMatrix(values, 13)
    symbols, at = r.integers(0, 13, 300), r.integers(0, 1001, 300)
    got = matrix.descend(symbols, at) - matrix.descend(symbols, np.zeros(300, np.int64))
    assert got.tolist() == [int((values[:k] == s).sum()) for s, k in zip(symbols, at)]
