import csv
import glob
import io
import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from shruti import backends, cli, jobs, schemas
from shruti.functions import ctc, editdist
from shruti.operators import corpus_eval
from shruti.sources import audio

FAKE = "shruti.backends:FakeBackend"


def tone(seconds, rate=16000, pitch=5):
    x = (np.sin(np.arange(int(seconds * rate)) / pitch) * 9000).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setparams((1, 2, rate, 0, "NONE", ""))
        f.writeframes(x.tobytes())
    return out.getvalue()


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def table(path, sep=","):
    parts = sorted(glob.glob(f"{path}/*.csv"))
    return [r for p in parts for r in csv.DictReader(open(p, newline="", encoding="utf-8"), delimiter=sep)]


def lines(path):
    return [x for p in sorted(glob.glob(f"{path}/part-*")) for x in open(p, encoding="utf-8").read().splitlines()]


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "c"
    put(root / "audio/r1.wav", tone(3, 8000))
    put(root / "audio/bad.wav", "junk")
    put(root / "dev/wav.scp", f"r1 {root}/audio/r1.wav\nr2 {root}/audio/bad.wav\nr3 cat {root}/audio/r1.wav |\n")
    put(root / "dev/segments", "u1 r1 0.0 1.0\nu2 r1 1.0 2.5\nu3 r2 0.0 1.0\nu4 r3 0.0 1.0\nu5 r9 0.0 1.0\nu6 r1 x\n")
    put(root / "dev/text", "u2 beta gamma\nu1 alpha, beta\nu3 alpha\nu4 alpha\nu5 alpha\nu6 alpha\nu7 alpha\n")
    put(root / "dev/utt2spk", "u1 s1\n")
    put(root / "eval/wav.scp", f"w1 {root}/audio/r1.wav\n")
    put(root / "eval/text", "w1 delta\nw2 none\n")
    return root


def test_cuts_read_what_clips_read(spark, corpus):
    path = f"{corpus}/audio/r1.wav"
    rows = [("a", path, 0.0, 1.0), ("b", path, 1.25, 2.5), ("c", path, None, None), ("d", path, 2.9, 9.0), ("e", path, 7.0, 8.0), ("f", f"file://{path}", 0.5, 0.5), ("g", "/none.wav", 0.0, 1.5), ("h", None, 0.0, 1.0), ("i", f"cat {path} |", 0.0, 1.0)]
    utterances = spark.createDataFrame(rows, "utt_id string, path string, start double, end double")
    whole = spark.createDataFrame([(p, (corpus / "audio/r1.wav").read_bytes()) for p in (path, f"file://{path}")], "path string, content binary")
    for rounding in ("offset_first", "joint", "ends"):
        cut = {r.utt_id: r for r in audio.cuts(utterances, rounding).collect()}
        clip = {r.utt_id: r for r in audio.clips(utterances, whole, rounding).collect()}
        for u in "abcdef":
            assert cut[u].audio_error is None and cut[u].wav == clip[u].wav and cut[u].seconds == clip[u].seconds
        assert all(cut[u].audio_error and cut[u].wav is None for u in "ghi") and cut["g"].seconds == 1.5
    assert {r.path: r.seconds for r in audio.lengths(utterances.where("path is not null")).collect()} == {path: 3.0, f"file://{path}": 3.0, "/none.wav": None, f"cat {path} |": None}


def test_kaldi(spark, corpus, tmp_path):
    out = f"{tmp_path}/out"
    cli.main(["kaldi", "--input", str(corpus), "--out", out, "--backend", FAKE, "--splits", "train,dev,eval", "--language", "te"])
    rows = {r["utt_id"]: r for r in table(f"{out}/dev_results.csv")}
    assert sorted(rows) == ["u1", "u2", "u3", "u4"] and list(rows["u1"]) == schemas.EVAL_COLUMNS
    assert rows["u1"]["spk_id"] == "s1" and rows["u2"]["spk_id"] == "unknown" and rows["u1"]["ref_normalized"] == "alpha beta"
    assert rows["u3"]["hypothesis"] == rows["u4"]["hypothesis"] == corpus_eval.AUDIO_FAILED
    read = audio.cuts(spark.createDataFrame([("u2", f"{corpus}/audio/r1.wav", 1.0, 2.5)], "utt_id string, path string, start double, end double"), "joint").first()
    assert rows["u2"]["hypothesis"] == backends.FakeBackend().transcribe([np.asarray(read.wav)], "te")[0]
    found = {(x := json.loads(line))["utt_id"]: x for line in lines(f"{out}/dev_manifest.json")}
    assert found["u2"] == {"audio_filepath": f"{corpus}/audio/r1.wav", "text": "beta gamma", "utt_id": "u2", "duration": 1.5, "offset": 1.0} and found["u4"]["audio_filepath"] == ""
    assert json.loads(lines(f"{out}/eval_manifest.json")[0]) == {"audio_filepath": f"{corpus}/audio/r1.wav", "text": "delta", "utt_id": "w1", "duration": 3.0}
    text = lines(f"{out}/summary.txt")
    assert text[0] == "Decoder: CTC | Language: te" and [x.split()[:2] for x in text[4:]] == [["dev", "2"], ["eval", "1"]]
    with pytest.raises(FileNotFoundError):
        jobs.split_files(spark, f"{corpus}/audio")


def test_folder(spark, tmp_path):
    root, out = tmp_path / "f", f"{tmp_path}/out.csv"
    for name, data in (("a.wav", tone(1)), ("b.wav", "junk"), ("c.wav", tone(1)), ("deep/d.wav", tone(1)), ("e.wav", tone(2))):
        put(root / "audio_16k" / name, data)
    for name, text in (("a.txt", " alpha \n"), ("b.txt", "beta"), ("d.txt", "gamma"), ("e.txt", ""), ("x.txt", "delta")):
        put(root / "transcripts" / name, text)
    totals = jobs.evaluate_folder(spark, str(root), out, backends.FakeBackend, "te").first()
    assert (totals.audio_files, totals.transcript_files, totals.pairs, totals.n, totals.n_skipped) == (4, 5, 3, 1, 2)  # d is a level deeper
    rows = table(out)
    assert [r["utterance_id"] for r in rows] == ["a", "b", "e"] and list(rows[0]) == schemas.FOLDER_COLUMNS
    assert rows[1]["hypothesis"] == corpus_eval.INFERENCE_FAILED and rows[0]["audio_path"] == f"{root}/audio_16k/a.wav" and float(rows[2]["WER"]) == -1
    with pytest.raises(FileNotFoundError):
        jobs.evaluate_folder(spark, str(root), out, backends.FakeBackend, "te", audio_dir="none")


def test_crosscheck(spark, corpus, tmp_path):
    said = backends.FakeBackend().transcribe([np.asarray(audio.cuts(spark.createDataFrame([(f"{corpus}/audio/r1.wav", 0.0, 1.0)], "path string, start double, end double"), "ends").first().wav)], "bn")[0]
    path = f"{corpus}/audio/r1.wav"
    rows = [("u1", path, 0, 1, said, said, "1"), ("u1", path, 0, 1, "x y", said, "2"), ("u2", "/none.wav", 0, 1, "a", "b", ""), ("u3", path, 0, 1, 'q "z", w', "k", "4")]
    with open(f"{tmp_path}/in.csv", "w", newline="", encoding="utf-8-sig") as f:
        w = csv.writer(f)
        w.writerow(["utt_id", "audio_path", "start_sec", "end_sec", "reference", "hypothesis", "wer"])
        w.writerows(rows)
    counts = {r.category: r.n for r in jobs.check_transcripts(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out", backends.FakeBackend, "bn").collect()}
    every, flagged = table(f"{tmp_path}/out/audio_analysis_results.csv"), table(f"{tmp_path}/out/audio_analysis_flagged.csv")
    assert len(every) == 4 == sum(counts.values()) and counts["AUDIO_ERROR"] == 1 and list(every[0]) == schemas.CROSSCHECK_COLUMNS
    by = {r["wer_orig"]: r for r in every}
    assert by["1"]["whisper"] == said and float(by["1"]["wjac_whisper_ref"]) == 1 and by["2"]["hypothesis"] == said and by["2"]["reference"] == "x y" and by["4"]["reference"] == 'q "z", w'
    assert by[""]["category"] == "AUDIO_ERROR" and by[""]["whisper"].startswith("ERROR:") and float(by[""]["end_sec"]) == 1
    assert {r["wer_orig"] for r in flagged} == {"2", "4"}


def test_alignment(spark, corpus, tmp_path):
    pieces = ["▁", "a", "l", "p", "h", "▁b", "e", "t"]
    put(tmp_path / "vocabulary", "\n".join(pieces) + "\n")
    out = f"{tmp_path}/out"
    cli.main(["qc", "--input", f"{corpus}/dev", "--out", out, "--backend", FAKE, "--vocabulary", f"{tmp_path}/vocabulary", "--threshold", "-50"])
    rows = table(f"{out}/quality_report.csv")
    assert [r["utt_id"] for r in rows] == ["u1", "u2", "u3", "u4", "u5"] and list(rows[0]) == schemas.QC_COLUMNS and [r["utt_id"] for r in table(f"{out}/quality_report.tsv", "\t")] == [r["utt_id"] for r in rows]
    by = {r["utt_id"]: r for r in rows}
    assert by["u5"]["error"] == "recording 'r9' not in wav.scp" and by["u5"]["audio_path"] == "r9  [0.000-1.000s]" and float(by["u5"]["score"]) == -99 and float(by["u5"]["audio_duration"]) == 1
    assert by["u3"]["error"] and by["u4"]["error"].startswith("no file") and by["u3"]["pass"] == "false"
    # the job's score of one utterance is that of its frames, normalised, and its ids
    wav = np.asarray(audio.cuts(spark.createDataFrame([(f"{corpus}/audio/r1.wav", 1.0, 2.5)], "path string, start double, end double")).first().wav, np.float32)
    x = backends.FakeBackend().logits(wav)
    x -= np.log(np.exp(x).sum(1, keepdims=True))
    ids = [i for i in by["u2"]["ref_tokens"] and [5, 6, 7, 1, 0, 1, 1]]
    assert by["u2"]["ref_tokens"].replace(" ", "") == "betaaa"
    path, scores = ctc.align(x, ids, 8)
    assert float(by["u2"]["forced_logprob"]) == pytest.approx(scores.sum()) and float(by["u2"]["greedy_logprob"]) == pytest.approx(x.max(1).sum())
    accepted, rejected = lines(f"{out}/accepted_utts.txt"), lines(f"{out}/rejected_utts.txt")
    assert accepted == sorted(accepted) and rejected[-3:] == ["u3", "u4", "u5"] and sorted(accepted + rejected) == list(by)
    summary = jobs.check_alignment(spark, f"{corpus}/eval", f"{tmp_path}/all", backends.FakeBackend, pieces, threshold=0.5).first()
    assert (summary.total, summary.accepted) == (1, 0) and lines(f"{tmp_path}/all/accepted_utts.txt") == [""]


def test_edits_are_made_once(spark):
    df = spark.createDataFrame([("a b c", "a x c"), ("", "b"), ("b", ""), ("", ""), (None, "x"), ("é", None)], "reference string, hypothesis string")
    results = corpus_eval.evaluate(df)
    plan = corpus_eval.summarize(results.withColumn("split", F.lit("s")), "split")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("levenshtein(") == 2
    rates = results.select(editdist.error_rates(F.col("ref_normalized"), F.col("hyp_normalized")).alias("r"), "WER", "CER").collect()
    assert all((x.r.WER, x.r.CER) == (x.WER, x.CER) for x in rates) and (results.first().WER, results.first().edits) == (pytest.approx(33.3333), (1, 1))
