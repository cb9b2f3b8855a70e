import random
import zlib

import numpy as np
import pytest

from shruti.llm import quality as q

from .corpora import clashing, documents, plain, unharmed


def corpus(spark, n=400, seed=1):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = r.random() < 0.7
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(r.choice([8, 40, 120]))]
        if not good:
            words = r.choice([[w + "%%%" for w in words], [words[0]] * len(words), [w.upper() + "!!" for w in words]])
        rows.append((i, " ".join(words)))
        if r.random() < 0.6:
            labels.append((i, int(good), r.randrange(2)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    out = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert len(out) == 400
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in known if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in out)
    assert len(held) > 40 and np.mean([out[i].predicted == known[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(spark, 200)
    from pyspark.sql import functions as F

    lied = labels.withColumn("quality", F.when(q.fold_of() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (plain(q.classify(docs, x), "doc_id", "score") for x in (labels, lied))
    assert a == b


def test_awkward_tables(spark):
    docs, rows = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, 0, 1), (None, 1, 0), (5, None, None), (9001, 0, 0), (10**9, 1, 1)], "doc_id long, quality int, toxic int")
    out = q.classify(clashing(docs), clashing(labels))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == len(rows)
    assert out.where("score is null or held_out is null").count() == 0
    same = {}
    for i, t, *_ in rows:
        for r in out.where(f"doc_id = {i}" if i is not None else "doc_id is null").collect() if i in (None, 3, 5, 9001, 9003) else ():
            assert same.setdefault(t or "", r.score) == r.score
    assert q.classify(docs.limit(0), labels).count() == 0
    none = q.classify(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]


def test_one_kind_of_label(spark):
    docs, labels = corpus(spark, 100)
    out = q.classify(docs, labels.where("quality = 1")).select("score").distinct().collect()
    assert len(out) == 1 and 0.9 < out[0].score < 1


def test_sample_is_bounded(spark, monkeypatch):
    docs, labels = corpus(spark, 300)
    seen = []
    monkeypatch.setattr(q, "fit", lambda x, y, fit=q.fit: seen.append(len(y)) or fit(x, y))
    q.train(docs.unionByName(docs), labels, max_train=50)
    assert seen == [50]


def test_keep_good(spark):
    docs, labels = corpus(spark)
    rows = clashing(docs)
    kept = q.keep_good(rows, labels)
    want = [r.doc_id for r in q.classify(docs, labels).where("predicted = 1").collect()]
    assert kept.columns == rows.columns and unharmed(kept) and sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_scores_are_sums_of_tables():
    r = np.random.default_rng(1)
    x = r.random((300, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # only a pair of features tells
    model = q.fit(x, y, n_pairs=1)
    assert set(model.pairs[0]) == {0, 1} and ((model.score(x) >= 0.5) == y).mean() > 0.95
    for k in range(20):
        z = model.intercept
        bins = [int(np.searchsorted(e, x[k, j], "left")) for j, e in enumerate(model.edges)]
        z += sum(t[b] for t, b in zip(model.tables, bins)) + sum(t[bins[i], bins[j]] for (i, j), t in zip(model.pairs, model.pair_tables))
        assert model.score(x[k : k + 1])[0] == pytest.approx(1 / (1 + np.exp(-z)))


def test_features_of_odd_texts():
    x = q.matrix(["", " ", "\n", "a", "É" * 10, "x" * 10**6, "\ud800"])
    assert np.isfinite(x).all() and x.shape == (7, len(q.FEATURES))
