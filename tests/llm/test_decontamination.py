import hashlib
import random
import re

import pytest

from shruti.llm import decontamination as d

from .corpora import clashing, documents, plain, texts, unharmed

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_force(text, items, width=13):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        v = words(t)
        for i in range(max(1, len(v) - width + 1)) if v else ():
            window = v[i : i + width]
            for j in range(len(w) - len(window) + 1):
                if w[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    ids.add("" if item is None else str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def items(rows):
    r = random.Random(4)
    long = [t for _, t, *_ in rows if t and len(words(t)) > 20]
    out = [(i, " ".join(words(r.choice(long))[3 : 3 + r.choice([5, 13, 14, 30])])) for i in range(25)]
    return out + [(100, "the"), (101, ""), (102, None), (None, out[0][1]), (103, out[1][1]), (103, out[2][1]), (104, "über É"), (105, "never seen words at all in any of these texts here " * 3), (20, out[3][1].upper())]


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_digest(spark, block):
    df, rows = documents(spark)
    bench = items(rows)
    want = [(i, *by_force(t, bench)) for i, t, *_ in rows]
    out = d.digest(clashing(df), clashing(spark.createDataFrame(bench, "item_id long, text string")), block_bytes=block)
    assert plain(out, *COLUMNS) == sorted(want, key=repr)
    assert any(w[5] for w in want) and any(w[2] and not w[5] for w in want)


def test_filter_keeps_all_columns(spark):
    df, rows = documents(spark)
    bench = items(rows)
    kept = [(i, t, lang) for i, t, lang, *_ in rows if not by_force(t, bench)[4]]
    out = d.decontaminate(clashing(df), spark.createDataFrame(bench, "item_id long, text string"))
    assert out.columns == clashing(df).columns and unharmed(out) and plain(out, "doc_id", "text", "lang") == sorted(kept, key=repr)


def test_empty_tables(spark):
    df, rows = documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 and not r.contaminated for r in d.digest(df, none).collect())
    assert d.digest(df.limit(0), none).count() == 0


@pytest.mark.parametrize("text", [None, "", " ", "?! ."])
def test_text_without_words_alone(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([("a", "one two")], "item_id string, text string")
    row = d.digest(docs, items).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (0, 0, False)


def test_wu_manber_finds_all_occurrences():
    r = random.Random(6)
    for _ in range(60):
        text = bytes(r.choice(b"ab ") for _ in range(r.randrange(1, 3000)))
        patterns = sorted({text[a : a + r.randrange(1, 30)] for a in (r.randrange(len(text)) for _ in range(8))} | {b"abba", b"bbbbbbbbbbbbbbb"})
        starts, found = d.WuManber(patterns).find(text)
        want = {(i, k) for k, p in enumerate(patterns) for i in range(len(text) - len(p) + 1) if text.startswith(p, i)}
        assert set(zip(starts, found)) == want


def test_texts_are_whole():
    assert max(map(len, texts())) > 100_000
