import math
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from shruti.functions import binding, ctc, editdist, recording, signal, similarity, textnorm


def one(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def py_normalize(text):
    import re

    text = unicodedata.normalize("NFC", text).strip()
    for mark in "।॥ఽ":
        text = text.replace(mark, "")
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", text)).strip().lower()


def test_normalize_is_pythons(spark):
    r = random.Random(1)
    fixed = ["తెలుగు భాష", "मराठी भाषा", "[AUDIO_FAILED]", "", "  　 ", "A b\x1cc d", "éX.y!", "a_b-c", "।a॥bఽ", "\x85x\x85", "ÉÈ ß", "1²2"]
    some = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x250), r.randrange(0x900, 0xD80), 0x301, 32, 0x2009, 10])) for _ in range(r.randrange(30))) for _ in range(400)]
    texts = [t for t in fixed + some if all(unicodedata.category(c) != "Cn" for c in t) and "ೝ" not in t]
    got = one(spark, "t string", [(t,) for t in texts], textnorm.normalize(F.col("t")))
    assert [g for (g,) in got] == [py_normalize(t) for t in texts]
    assert py_normalize("తెలుగు భాష") == "తలగ భష" and one(spark, "t string", [(None,)], textnorm.normalize(F.col("t"))) == [(None,)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distances(spark):
    r = random.Random(2)
    words = ["a", "b", "é", "日本", "long", "x1"]
    pairs = [(" ".join(r.choice(words) for _ in range(r.randrange(12))), " ".join(r.choice(words) for _ in range(r.randrange(12)))) for _ in range(300)]
    pairs += [("", ""), ("a", ""), ("", "b c"), (" ".join(map(str, range(2000))), " ".join(map(str, range(3, 2000))))]
    got = one(spark, "a string, b string", pairs, editdist.word_edits(F.col("a"), F.col("b")), editdist.char_edits(F.col("a"), F.col("b")))
    assert [w for w, _ in got] == [edits(a.split(), b.split()) for a, b in pairs]
    assert [c for _, c in got[:-1]] == [edits(a, b) for a, b in pairs[:-1]]


def test_error_rates_of_empties(spark):
    rates = editdist.error_rates(F.col("a"), F.col("b"))
    got = one(spark, "a string, b string", [("", ""), ("", "x"), ("x", ""), (None, None), ("a b", "a c"), ("a b", "a b")], rates["WER"], rates["CER"])
    assert got == [(0.0, 0.0), (-1.0, -1.0), (100.0, 100.0), (0.0, 0.0), (50.0, 33.3333), (0.0, 0.0)]


def test_jaccards(spark):
    rows = [("a b", "b c"), ("", ""), ("", "x"), (None, "x"), ("aa b", "ab  a"), ("x", "x")]
    got = one(spark, "a string, b string", rows, similarity.word_jaccard(F.col("a"), F.col("b")), similarity.char_jaccard(F.col("a"), F.col("b")))
    assert got == [(1 / 3, 1 / 3), (1.0, 1.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    back = one(spark, "b string, a string", rows, similarity.word_jaccard(F.col("a"), F.col("b")))
    assert [w for (w,) in back] == [w for w, _ in got]


def test_categories(spark):
    rows = [
        ("", 1.0, 1.0, 1.0, 1.0, "WHISPER_SILENT"), (" NaN ", 1.0, 1.0, 1.0, 1.0, "WHISPER_SILENT"), (None, 1.0, 1.0, 1.0, 1.0, "WHISPER_SILENT"), ("w", 0.5, 0.5, 0.0, 0.0, "AGREE_BOTH"),
        ("w", 0.5, 0.29, 0.0, 0.0, "AGREE_REF_ONLY"), ("w", 0.29, 0.5, 0.0, 0.0, "AGREE_HYP_ONLY"), ("w", 0.0, 0.0, 0.29, 0.29, "DISAGREE_BOTH_STRONG"), ("w", 0.29, 0.29, 0.3, 0.29, "DISAGREE_BOTH"),
        ("w", 0.5, 0.4, 0.6, 0.6, "PARTIAL_MATCH"),
    ]
    got = one(spark, "t string, a double, b double, c double, d double, want string", rows, similarity.categorize(*(F.col(c) for c in "tabcd")), "want")
    assert all(a == b for a, b in got)


def test_recordings(spark):
    rows = [
        ("001_Nagpur_M_34_monologue_00012", "monologue", "001_Nagpur_M_34", "001_Nagpur_M_34_monologue_00012", None), ("bn_IN_12_3_Left", "stereo_channel", "bn_IN_12_3_Left", "bn_IN_12_3_Left", None),
        ("be_SHA1P_C2_r020_s002", "vendor", None, "be_SHA1P_C2_r020_s002", None), ("whatever", "unknown", None, "whatever", None), ("bn_IN_1_2_Right_WB", "stereo_channel", "bn_IN_1_2_Right", "bn_IN_1_2_Right", "WB"),
        ("x_NB", "unknown", None, "x", "NB"), ("1_A_MM_3_", "monologue", "1_A_MM_3", "1_A_MM_3_", None),
    ]
    c = recording.classify(F.col("r"))
    got = one(spark, "r string, f string, s string, b string, band string", rows, c["family"], c["speaker"], c["base"], recording.band(F.col("r")))
    assert got == [r[1:] for r in rows]


def test_entries(spark):
    rows = [("sox a.wav -t wav - |", True, "sox", "sox"), ("/a//b/c.wav", False, "/a//b/c.wav", "c.wav"), ("", False, "", ""), ("x y", False, "x", "x"), (None, False, "", "")]
    got = one(spark, "e string, p boolean, t string, b string", rows, recording.is_pipe(F.col("e")), recording.first_token(F.col("e")), recording.basename(recording.first_token(F.col("e"))))
    assert got == [r[1:] for r in rows]
    names = [("a/b.c.wav", "b.c"), ("x", "x"), ("/d/.hidden", ".hidden")]
    assert one(spark, "p string, s string", names, recording.stem(F.col("p"))) == [(s,) for _, s in names]
    label = recording.audio_label(F.col("p"), F.col("a"), F.col("b"))
    assert one(spark, "p string, a double, b double", [("/x.wav", 0.5, 5.91), ("/y.wav", None, None)], label) == [("/x.wav  [0.500-5.910s]",), ("/y.wav",)]
    assert one(spark, "u string", [("a/b/c",)], recording.file_safe(F.col("u"))) == [("a_b_c",)]


def py_wada(wav):
    x = np.abs(np.asarray([np.nan if v is None else v for v in wav], np.float64))
    if not len(x) or not np.isfinite(x).any():
        return math.nan
    x = np.maximum(x, 1e-10)
    return float(np.interp(math.log(x.mean()) - np.log(x).mean(), signal.WADA_TABLE, np.arange(-20, 101)))


def test_wada(spark):
    assert len(signal.WADA_TABLE) == 121 and np.all(np.diff(signal.WADA_TABLE) > 0)
    r = np.random.default_rng(1)
    wavs = [r.normal(size=400), r.laplace(size=400), np.zeros(50), np.sin(np.arange(400)), np.ones(5), np.zeros(0)] + [r.normal(size=3000) * (1 + 0.02 * k) ** r.normal(size=3000) for k in range(20)]
    got = one(spark, "i int, w array<double>", [(i, w.tolist()) for i, w in enumerate(wavs)], signal.wada_snr(F.col("w")))
    for (g,), w in zip(got, wavs):
        want = py_wada(w)
        assert (math.isnan(g) and math.isnan(want)) or g == pytest.approx(want, abs=1e-6)
    nothing = one(spark, "w array<double>", [([math.nan],), (None,), ([0.1, math.nan, 0.3],), ([0.1, math.inf, 0.3],), ([-math.inf, 0.1],)], signal.wada_snr(F.col("w")))
    assert all(math.isnan(g) for (g,) in nothing)
    scaled = one(spark, "w array<double>", [(wavs[7].tolist(),), ((wavs[7] * 1000).tolist(),)], signal.wada_snr(F.col("w")))
    assert scaled[0][0] == pytest.approx(scaled[1][0], abs=1e-6)


def test_signal_columns(spark):
    w = [float(i) for i in range(10)]
    for how, want in (("offset_first", [2, 1, 3]), ("joint", [2, 0, 3]), ("ends", [2, 0, 3])):
        got = one(spark, "w array<double>, s double, e double", [(w, 1.2, 3.9), (w, 4.1, 4.2), (w, 7.0, 20.0)], F.size(signal.segment(F.col("w"), F.lit(1.0), F.col("s"), F.col("e"), how)))
        assert [g for (g,) in got] == want, how
    assert one(spark, "c array<array<double>>", [([[1.0, 2.0], [3.0, 6.0]],), ([[1.0]],)], signal.mono(F.col("c"))) == [([2.0, 4.0],), ([1.0],)]
    assert one(spark, "w array<double>", [([32768.0, -16384.0],), ([0.5],), ([],)], signal.unit_scaled(F.col("w"))) == [([1.0, -0.5],), ([0.5],), ([],)]


@pytest.mark.parametrize("rate", [8000, 22050, 44100, 48000])
def test_resampling_keeps_tones(rate):
    t = np.arange(rate) / rate
    out = signal.resample(np.sin(2 * np.pi * 440 * t), rate)
    assert len(out) == 16000
    want = np.sin(2 * np.pi * 440 * np.arange(16000) / 16000)
    assert np.abs(out - want)[200:-200].max() < 0.01
    assert np.abs(signal.resample(np.ones(rate), rate)[200:-200] - 1).max() < 0.01
    if rate > 16000:
        assert np.abs(signal.resample(np.sin(2 * np.pi * 9500 * t), rate)[200:-200]).max() < 0.2
    assert len(signal.resample(np.zeros(0), rate)) == 0


# CTC


def frames(r, t=8, v=5):
    x = r.normal(size=(t, v)) * 2
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def best_forced(f, target, blank):
    """The recurrence over all paths, by memo."""
    z = [blank]
    for k in target:
        z += [k, blank]
    from functools import cache

    @cache
    def go(t, s):
        if t == 0:
            return f[0, z[s]] if s < 2 else -math.inf
        options = [go(t - 1, s)] + ([go(t - 1, s - 1)] if s else []) + ([go(t - 1, s - 2)] if s > 1 and z[s] != blank and z[s] != z[s - 2] else [])
        return f[t, z[s]] + max(options)

    return max(go(len(f) - 1, len(z) - 1), go(len(f) - 1, len(z) - 2))


def collapse(ids, blank):
    out = []
    for i, x in enumerate(ids):
        if x != blank and (i == 0 or x != ids[i - 1]):
            out.append(int(x))
    return out


def test_forced_alignment_and_greedy(spark):
    r = np.random.default_rng(3)
    rows = []
    for i in range(60):
        t = int(r.integers(4, 12))
        target = r.integers(0, 4, r.integers(1, 4)).tolist()
        rows.append((i, frames(r, t).tolist(), target))
    df = spark.createDataFrame(rows, "i int, f array<array<double>>, t array<int>").withColumn("a", ctc.align_udf(4)(F.col("f"), F.col("t")))
    spans = ctc.spans(F.col("a.path"), 4)
    got = df.select("i", ctc.forced_logprob(F.col("f"), F.col("t"), 4).alias("forced"), ctc.greedy_logprob(F.col("f")).alias("best"), ctc.greedy(F.col("f"), 4).alias("ids"), "a", spans.alias("s"), ctc.token_scores(spans, F.col("a.scores")).alias("ts")).collect()
    assert len(got) == 60
    for row in got:
        _, f, target = rows[row.i]
        f = np.array(f)
        assert collapse(f.argmax(1).tolist(), 4) == row.ids and row.best == pytest.approx(f.max(1).sum())
        if len(f) < len(target) + sum(a == b for a, b in zip(target, target[1:])):
            assert row.a.path is None
            continue
        assert row.forced == pytest.approx(best_forced(f, target, 4)) and row.forced <= row.best + 1e-9
        assert collapse(row.a.path, 4) == target and sum(row.a.scores) == pytest.approx(row.forced)
        runs = [s for s in row.s]
        assert [s.token for s in runs] == target
        for s, score in zip(runs, row.ts):
            assert set(row.a.path[s.s : s.e]) == {s.token} and score == pytest.approx(np.mean(row.a.scores[s.s : s.e]))


def test_slices(spark):
    raw = np.random.default_rng(4).normal(size=(6, 10))
    part = ctc.language_slice(10, ["a", "b", "c"], "b")
    assert (part.offset, part.width, part.blank) == (3, 3, 9)
    cut = np.concatenate([raw[:, 3:6], raw[:, 9:]], 1)
    want = cut - np.log(np.exp(cut).sum(1, keepdims=True))
    got = one(spark, "f array<array<double>>", [(raw.tolist(),)], ctc.sliced(F.col("f"), part))[0][0]
    assert np.allclose(got, want)
    flags = one(spark, "f array<double>", [(raw[0].tolist(),), (want[0].tolist(),)], ctc.is_log_probability(F.col("f")))
    assert flags == [(False,), (True,)]
    twelve = ctc.language_slice(5633, [str(i) for i in range(22)], "12")
    assert (twelve.offset, twelve.width) == (3072, 256) and ctc.language_slice(5633, [str(i) for i in range(22)], "5").offset == 1280
    assert ctc.language_slice(300, offsets={"x": 10}, language="x").width == 256 and ctc.language_slice(9).width == 8
    for bad in (dict(n_classes=11, languages=["a", "b", "c"], language="a"), dict(n_classes=10, offsets={"x": 9}, language="x", width=3), dict(n_classes=10, languages=["a"], language="z"), dict(n_classes=4, blank=4)):
        with pytest.raises(ValueError):
            ctc.language_slice(**bad)
    assert ctc.frame_shift(0.01, 8) == pytest.approx(0.08) and ctc.frame_shift(160, 8) == pytest.approx(0.08) and ctc.frame_shift(0.01, 4, 13) == pytest.approx(1 / 13)


def test_target_errors(spark):
    rows = [([], 8, "empty target"), ([1, 9, 4, -1], 8, "invalid ids: 9,4,-1"), ([1, 1, 1], 4, "too few frames: 4 < 5"), ([1, 2], 2, ""), (None, 3, "empty target"), ([7] * 9, 20, "invalid ids: 7,7,7,7,7")]
    got = one(spark, "t array<int>, n int, e string", rows, ctc.target_error(F.col("t"), F.lit(5), F.col("n"), 4), "e")
    assert all(a == b for a, b in got)


def test_ids_and_text(spark):
    rows = [([0, 5, 1], [5]), ([0, 1], []), ([5], [5]), ([], []), ([1], []), ([2, 0], [2, 0])]
    assert one(spark, "i array<int>, w array<int>", rows, ctc.strip_ends(F.col("i"), 0, 1)) == [(w,) for _, w in rows]
    assert one(spark, "i array<int>", [([1, 0],)], ctc.strip_ends(F.col("i"), -1, -1)) == [([1, 0],)]
    vocabulary = ["▁a", "▁", "b", "bc", "d"]
    ids = [i for (i,) in one(spark, "t string", [("abc d",), ("",), (None,), ("zb",)], ctc.text_to_ids(vocabulary)(F.col("t")))]
    assert ids == [[0, 3, 1, 4], [], [], [1, 2]]
    assert one(spark, "i array<int>", [(ids[0],), ([99],)], ctc.ids_to_text(F.col("i"), vocabulary)) == [("abc d",), ("?",)]
    assert one(spark, "i array<int>", [([3, 4],)], ctc.ids_to_text(F.col("i"), None)) == [("3 4",)]


def test_matched_transcripts_score_above_shuffled_ones(spark):
    r = np.random.default_rng(5)
    targets = [r.integers(0, 6, 4).tolist() for _ in range(30)]
    rows = []
    for i, t in enumerate(targets):
        x = np.full((12, 7), -3.0)
        x[:, 6] = 0
        for k, token in enumerate(t):
            x[3 * k, 6], x[3 * k, token] = -3, 2
        x += r.normal(size=x.shape) * 0.3
        x -= np.log(np.exp(x).sum(1, keepdims=True))
        rows.append((x.tolist(), t, targets[(i + 1) % 30]))
    score = lambda c: (ctc.forced_logprob(F.col("f"), F.col(c), 6) - ctc.greedy_logprob(F.col("f"))) / 4
    got = np.array(one(spark, "f array<array<double>>, t array<int>, u array<int>", rows, score("t"), score("u")))
    assert got[:, 0].mean() > -0.5 > -1.5 > got[:, 1].mean()


def test_let_computes_once(spark):
    got = one(spark, "x int", [(3,)], binding.let(F.col("x") + 1, lambda y: F.transform(F.array(F.lit(1), F.lit(2)), lambda z: z * y)))
    assert got == [([4, 8],)]
