"""Small corpora that hold every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators also make themselves.
CLASHING = ["score", "ta", "_ta", "n", "sid", "length", "piece", "host", "spans", "__hits", "_salt", "y", "component", "least", "lo", "kind", "key", "wanted", "__doc0", "_word", "_bit", "_mask", "_doc", "_again", "n_words", "ranges", "n_hit", "items", "n_hit_", "SCORE_"]


def texts(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeiounstrhl") for _ in range(r.randint(1, 6))) for _ in range(120)] + ["É", "über", "the", "THE", "x y", "日本語"]
    out = [" ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 3, 9, 12, 25, 60, 150]))) for _ in range(n)]
    for _ in range(n // 2):  # near copies of all degrees
        words = r.choice(out).split(" ")
        for _ in range(r.choice([0, 1, 1, 2, 5])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        if r.random() < 0.3:
            words = words[: max(1, len(words) - 1)]
        out.append(r.choice([" ", "\n", "\t ", "\x0b"]).join(words))
    passage = " ".join(r.choice(vocabulary) for _ in range(70))
    for k in range(6):  # a passage in several texts
        out.append(f"{r.choice(out)} {passage if k % 2 else passage[:-9]} {r.choice(out)}")
    out += ["", " \n\t ", "word", "a b", "A B", "a b c", "same " * 200, "x" * 5000, "ab cd " * 20000, "\x00nul \x1c sep", "a b"]
    return out


def documents(spark, seed=1, n=60):
    """doc_id 0.. in a mixed order, with a null text, a null id and repeated rows."""
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts(seed, n))]
    rows += [rows[3], rows[3], rows[5], (9001, None, None, None, None), (None, rows[7][1], None, None, None), (9003, None, "de", "s", 0)]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5), rows


def clashing(df):
    """The same rows with further columns of awkward names."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"clash {c}") for c in CLASHING})


def unharmed(df):
    """Whether the columns of ``clashing`` are as they were."""
    return df.columns[-len(CLASHING) :] == CLASHING and all(r[c] == f"clash {c}" for r in df.select(*CLASHING).distinct().collect() for c in CLASHING)


def plain(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
