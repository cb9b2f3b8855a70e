import os

import numpy as np
import pytest

from shruti.llm import common, hashing


def test_scratch_removes_what_is_not_kept(spark):
    with common.scratch(spark):
        a = common.stored(spark.range(5), "a")
        with common.scratch(spark):
            b = common.stored(a.selectExpr("id + 1 as id"), "b")
            c = common.stored(b.selectExpr("id * 2 as id"), "c", keep=True)
        assert sorted(r.id for r in c.collect()) == [2, 4, 6, 8, 10]
        d = common.stored(c, "d", keep=True)
    left = os.listdir(common.shared_dir(spark).removeprefix("file:"))
    assert any(x.startswith("llm-d-") for x in left) and not any(x.startswith(("llm-a-", "llm-b-", "llm-c-")) for x in left)
    assert d.count() == 5


@pytest.mark.parametrize("words", [1, 1 << 10])
def test_met_loses_no_row(spark, monkeypatch, words):
    monkeypatch.setattr(common, "FILTER_WORDS", words)
    rows = spark.range(2000).selectExpr("id", "xxhash64(id) as k", "1 as _word", "2 as _bit_").unionByName(spark.sql("select 5000L as id, null as k, 1 as _word, 2 as _bit_"))
    wanted = rows.where("id % 100 = 0 and id < 2000").select("k")
    maybe, never = common.met(rows, wanted, "k")
    assert maybe.columns == never.columns == rows.columns
    some, others = ({r.id for r in x.collect()} for x in (maybe, never))
    assert some >= set(range(0, 2000, 100)) and some.isdisjoint(others) and some | others == {*range(2000), 5000}
    assert words == 1 or len(some) < 60
    assert all(x._word == 1 and x._bit_ == 2 for x in maybe.collect())
    assert common.met(rows, wanted.limit(0), "k")[0].count() == 0


def test_fresh_names(spark):
    df = spark.sql("select 1 as A, 2 as a_, 3 as c")
    assert common.fresh(df, "a", "b", "b") == ["a__", "b", "b_"]


def test_chunks_cover_everything_in_order():
    sizes = [3, 100, 1, 1, 50, 60, 0, 0, 200]
    got = list(common.chunks(sizes, 100))
    assert [i for a, b in got for i in range(a, b)] == list(range(9))
    assert all(sum(sizes[a:b]) <= 100 or b - a == 1 for a, b in got) and list(common.chunks([], 5)) == []


def test_word_hashes_tell_words_apart_whatever_surrounds_them():
    texts = [b"a b  c\n", b"", b"abc ab c", b"c", "é É\xa0x".encode(), b"x" * 10000 + b" a"]
    h, at = hashing.words(texts, False)
    assert at.tolist() == [0, 3, 3, 6, 7, 9, 11]
    flat = [w for t in texts for w in t.split()]
    for i, x in enumerate(flat):
        for j, y in enumerate(flat):
            assert (h[i] == h[j]) == (x == y)
    lower, _ = hashing.words([b"A bC", "É".encode()], True)
    assert lower[:2].tolist() == hashing.words([b"a bc"], False)[0].tolist() and lower[2] != hashing.words(["é".encode()], False)[0][0]


def test_window_hashes_tell_windows_apart():
    r = np.random.default_rng(1)
    words = hashing.mix(r.integers(0, 3, 400).astype(np.uint64))
    levels = hashing.doubled(words, 50)
    for size in (1, 2, 3, 33, 50):
        h = hashing.windows(levels, size)
        keys = [words[i : i + size].tobytes() for i in range(400 - size + 1)]
        assert len(h) == len(keys) and len(set(h.tolist())) == len(set(keys)) == len(set(zip(h.tolist(), keys)))
    assert len(hashing.windows(hashing.doubled(words[:5], 50), 50)) == 0
