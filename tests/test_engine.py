import csv
import io
import json
import math
import os
import wave

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from shruti import backends, cli, schemas
from shruti.functions import signal
from shruti.operators import audit, corpus_eval, crosscheck, joins, qc
from shruti.plans import oracles, queries
from shruti.sinks import files
from shruti.sources import audio, kaldi, tables
from shruti.streaming import ingest

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def rows_of(df):
    df = df[sorted(df.columns)]
    clean = lambda v: None if v is None or v != v else round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(clean(v) for v in row) for row in df.astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_match_their_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        assert name in ("token_scores", "qc_report") and len(got)
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


@pytest.mark.parametrize(
    "waves",
    [
        [[0.272029], [0.438272], [0.389687], [0.460418], [0.410153]],  # products of 64 bits lie on the other side of a half
        [[-1e-6], [-1e-5, 1e-6], [1e-6], [0.0], [-0.0], [0.5, -0.5]],  # sums that round to zero, from either side
        [None, [], [None], [0.25, None, -0.75], [0.1, math.nan], [math.inf], [-math.inf, 2.0]],
    ],
)
def test_unit_scale_gives_the_rows_of_its_sql(spark, tmp_path, waves):
    e = spark.createDataFrame(list(enumerate(waves)), "vec_id long, embedding array<float>")
    e.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["unit_scale"](spark, str(tmp_path)).orderBy("vec_id").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(oracles.oracle_sql()["unit_scale"] + " ORDER BY vec_id").fetchall()
    assert list(map(repr, map(tuple, got))) == list(map(repr, want))  # 0.0 and -0.0 differ


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(oracles.oracle_sql()) <= set(queries.QUERIES) <= set(__spark_entry__.queries())


def test_import_without_the_training_data_operators(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    shutil.copytree(f"{root}/shruti", tmp_path / "shruti", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') and k[2].isdigit() for k in e.queries()))"], cwd=tmp_path, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(queries.QUERIES)), "False"], out.stderr


# Readers


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_kaldi_readers(spark, tmp_path):
    text = write(f"{tmp_path}/text", "utt1 a  b \r\n\n  utt2\tc\r\nkeyonly\nutt1 last\n   \nutt3 తెలుగు  x")
    assert got(kaldi.text(kaldi.lines(spark, text)), "utt_id", "transcript", "line_no") == [("keyonly", "", 3), ("utt1", "last", 0), ("utt2", "c", 2), ("utt3", "తెలుగు  x", 6)]
    wav = write(f"{tmp_path}/wav.scp", "r1 sox x.wav -t wav - |\nr2\nr3 /p//q.wav\n")
    assert got(kaldi.wav_scp(kaldi.lines(spark, wav)), "rec_id", "audio_source") == [("r1", "sox x.wav -t wav - |"), ("r3", "/p//q.wav")]
    assert len(got(kaldi.wav_scp(kaldi.lines(spark, wav), need_value=False), "rec_id")) == 3
    seg = write(f"{tmp_path}/segments", "u1 r1 0.5 5.9\nu2 r1 1\nu3 r1 1 2 3\nu1 r2 9 7\n\n")
    assert got(kaldi.segments(kaldi.lines(spark, seg)), "utt_id", "rec_id", "start_sec", "end_sec") == [("u1", "r2", 9.0, 7.0)]
    assert got(kaldi.malformed_segments(kaldi.lines(spark, seg)), "line_no") == [(1,), (2,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        kaldi.segments(kaldi.lines(spark, write(f"{tmp_path}/bad", "u r x 1\n"))).collect()
    spk = write(f"{tmp_path}/utt2spk", "u1 s1 more\nu2\nu1 s2\n")
    assert got(kaldi.utt2spk(kaldi.lines(spark, spk)), "utt_id", "spk_id") == [("u1", "s2")]
    dur = write(f"{tmp_path}/utt2dur", "u1 3.2\nu2 x\nu3\n")
    assert got(kaldi.utt2dur(kaldi.lines(spark, dur)), "utt_id", "duration") == [("u1", 3.2)]
    assert kaldi.lines(spark, f"{tmp_path}/none", optional=True).count() == 0
    assert kaldi.text(kaldi.lines(spark, write(f"{tmp_path}/empty", ""))).count() == 0


def test_broken_utf8_is_replaced(spark, tmp_path):
    with open(tmp_path / "text", "wb") as f:
        f.write(b"u1 a\xffb\n")
    assert got(kaldi.text(kaldi.lines(spark, str(tmp_path / "text"))), "transcript") == [("a�b",)]


def test_csv_with_mark_and_missing_columns(spark, tmp_path):
    path = write(f"{tmp_path}/r.csv", '﻿utt_id,reference,wer\r\nu1,"a ""q"", b\nline2",0.5\r\n')
    row = tables.read_csv(spark, path, schemas.CROSSCHECK).first()
    assert (row.utt_id, row.reference.replace("\r", ""), row.wer, row.hypothesis) == ("u1", 'a "q", b\nline2', "0.5", None)
    assert len(row) == 10


# Joins and audit

T = "utt_id string, transcript string"
S = schemas.SEGMENTS
W = schemas.WAV_SCP


def test_located(spark):
    text = spark.createDataFrame([("u1", "a"), ("u2", "b"), ("u3", "c")], T)
    seg = spark.createDataFrame([("u1", "r1", 0.0, 1.0), ("u2", "r9", 0.0, 1.0), ("x", "r1", 0.0, 1.0)], S)
    wav = spark.createDataFrame([("r1", "/a.wav"), ("u3", "/u3.wav")], W)
    rows = joins.located(text, seg, wav)
    assert got(rows, "utt_id", "reason") == [("u1", None), ("u2", "recording_missing"), ("u3", "no_segment")]
    spk = spark.createDataFrame([("u9", "s")], schemas.UTT2SPK)
    assert got(joins.utterances(rows, spk), "utt_id", "spk_id") == [("u1", "unknown")]
    assert got(joins.utterances(joins.located(text, None, wav)), "utt_id", "audio_source", "start") == [("u3", "/u3.wav", None)]
    assert got(joins.losses(rows), "reason", "n") == [("no_segment", 1), ("recording_missing", 1)]


def split(spark, schema, rows):
    return spark.createDataFrame([("c", "s", *r) for r in rows], f"corpus string, split string, {schema}")


def test_waterfall_order(spark):
    text = split(spark, T, [("u1", "a"), ("u2", "a"), ("u3", " "), ("u4", " "), ("u5", "a"), ("u6", "a")])
    seg = split(spark, S, [("u1", "r1", 0.0, 3600.0), ("u2", "r2", 5.0, 1.0), ("u3", "r1", 0.0, 1.0), ("u4", "gone", 0.0, 1.0), ("u6", "lost", 0.0, 1.0)])
    resolved = split(spark, "rec_id string, resolution string", [("r1", "as_given"), ("r2", "by_name"), ("lost", "unresolved")])
    rows = audit.waterfall(text, seg, resolved)
    assert got(rows, "utt_id", "reason") == [("u1", None), ("u2", None), ("u3", "empty_transcript"), ("u4", "not_in_wav_scp"), ("u5", "no_segment"), ("u6", "audio_missing")]
    row = audit.utterance_counts(rows).first()
    assert (row.verifiable_utts, row.verifiable_as_given, row.hours, row.layout) == (2, 1, 1.0, "segmented")
    assert row.utts_in_text == row.verifiable_utts + sum(row[f"lost_{r}"] for r in audit.LOSSES)


def test_resolution(spark):
    wav = spark.createDataFrame([("a", "/d/a.wav"), ("b", "/x/b.wav"), ("c", "sox z.wav |"), ("d", ""), ("e", "/x/none.wav"), ("f", None), ("g", "|")], W)
    present = spark.createDataFrame([("/d/a.wav",), ("|",)], "path string")
    index = spark.createDataFrame([("b.wav", "/i/b.wav"), ("c.wav", "/i/c.wav"), ("d.wav", "/i/d.wav"), ("f.wav", "/i/f.wav")], schemas.AUDIO_INDEX)
    rows = got(audit.resolve_paths(wav, present, index), "rec_id", "resolution", "path", "is_pipe")
    assert rows == [
        ("a", "as_given", "/d/a.wav", False), ("b", "by_name", "/i/b.wav", False), ("c", "by_name", "/i/c.wav", True), ("d", "by_name", "/i/d.wav", False),
        ("e", "unresolved", None, False), ("f", "by_name", "/i/f.wav", False), ("g", "unresolved", None, True),
    ]


def test_fallback_index(spark):
    index = spark.createDataFrame([("a", "x.wav", "/a/x.wav"), ("b", "y.wav", "/b/y.wav"), ("b_final", "z.wav", "/bf/z.wav")], "corpus string, basename string, path string")
    corpora = spark.createDataFrame([("a",), ("a_cleaned",), ("b_final",), ("c_final",)], "corpus string")
    assert got(audit.with_fallback_index(index, corpora), "corpus", "path") == [("a", "/a/x.wav"), ("a_cleaned", "/a/x.wav"), ("b_final", "/bf/z.wav")]


def test_audit_of_a_tree(spark, tmp_path):
    root = f"{tmp_path}/root"
    for corpus in ("P_x", "P_x_cleaned"):
        write(f"{root}/{corpus}/train/text", "u1 a\nu2 b\nu3 c\n")
        write(f"{root}/{corpus}/train/wav.scp", "1_City_M_30_m_1 1_City_M_30_m_1.wav\nr2_WB /nowhere/r2.wav\n")
        write(f"{root}/{corpus}/train/segments", "u1 1_City_M_30_m_1 0 7200\nu2 r2_WB 0 1\n")
        write(f"{root}/{corpus}/train/utt2spk", "u1 u1\nu2 s\n")
    write(f"{root}/P_x/dev/text", "r1 t\n")
    write(f"{root}/P_x/dev/wav.scp", "r1 r1.wav\n")
    write(f"{root}/P_x/dev/utt2dur", "r1 36\n")
    for name in ("1_City_M_30_m_1.wav", "r1.WAV", "r1.wav"):
        write(f"{root}/P_x/Audio/deep/{name}", "x")
    rows = {(r.corpus, r.split): r for r in cli.audit_root(spark, root, "P_", ["train", "dev"]).collect()}
    assert set(rows) == {("P_x", "train"), ("P_x_cleaned", "train"), ("P_x", "dev")}
    for corpus in ("P_x", "P_x_cleaned"):
        r = rows[corpus, "train"]
        assert (r.utts_in_text, r.verifiable_utts, r.lost_audio_missing, r.lost_no_segment, r.hours, r.fam_monologue, r.band_WB, r.utt2spk_degenerate, r.segments) == (3, 1, 1, 1, 2.0, 1, 1, 1, 2)
    assert (rows["P_x", "dev"].layout, rows["P_x", "dev"].hours, rows["P_x", "dev"].verifiable_utts) == ("one-file-per-utterance", 0.01, 1)
    report = spark.createDataFrame(list(rows.values()))
    assert audit.totals(report).first().verifiable_utts == 2 and report.columns == schemas.AUDIT_COLUMNS
    files.write_csv(report.limit(0), f"{tmp_path}/empty.csv")
    assert spark.read.text(f"{tmp_path}/empty.csv").first().value == ",".join(schemas.AUDIT_COLUMNS)
    with pytest.raises(FileNotFoundError):
        cli.audit_root(spark, root, "Q", ["train"])


# Evaluation, cross-check, agreement


def test_failed_rows(spark):
    rows = spark.createDataFrame([("s", "a b", "a b"), ("s", "a b", None), ("s", "", "x"), ("s", "c d", "[INFERENCE_FAILED]"), ("t", "", "")], "split string, reference string, hypothesis string")
    results = corpus_eval.evaluate(rows)
    s = {r.split: r for r in corpus_eval.summarize(results, "split").collect()}
    assert (s["s"].n, s["s"].n_skipped, s["s"].corpus_wer) == (1, 3, 0.0) and (s["t"].n, s["t"].n_skipped, s["t"].avg_wer) == (0, 1, 0.0)
    s = {r.split: r for r in corpus_eval.summarize(results, "split", compat_failed_rows=True).collect()}
    assert (s["s"].n, s["s"].n_skipped) == (3, 1) and s["s"].corpus_wer == round(400 / 6, 4)


def test_crosscheck_errors(spark):
    rows = spark.createDataFrame([("a", "a", "a", None, None), ("a", "a", "a", "x", None), ("a", "a", "a", None, "y"), (None, "b", "", None, None)], "reference string, hypothesis string, whisper string, audio_error string, whisper_error string")
    out = crosscheck.crosscheck(rows).collect()
    assert [r.category for r in out] == ["AGREE_BOTH", "AUDIO_ERROR", "WHISPER_ERROR", "WHISPER_SILENT"]
    assert [r.wjac_whisper_ref for r in out] == [1.0, 0.0, 0.0, 0.0]
    assert got(crosscheck.histogram(crosscheck.crosscheck(rows)), "category", "n", "percent")[0] == ("AGREE_BOTH", 1, 25.0)
    assert crosscheck.flagged(crosscheck.crosscheck(rows)).count() == 0


def test_quality_report(spark, tmp_path):
    r = np.random.default_rng(2)
    rows = []
    for i, target in enumerate([[0, 1], [], [9], [2, 2, 2, 2, 2], [1]]):
        x = r.normal(size=(6, 4))
        x -= np.log(np.exp(x).sum(1, keepdims=True))
        rows.append((f"u{i}", f"text, {i}", "/a.wav", 0.0 if i else None, 1.0 if i else None, r.normal(size=50).tolist(), x.tolist(), target, 0.48))
    df = spark.createDataFrame(rows, "utt_id string, text string, path string, start double, end double, wav array<double>, frames array<array<double>>, target array<int>, audio_duration double")
    report = qc.report(qc.score(df, 4, 3), threshold=-50)
    out = {x.utt_id: x for x in report.collect()}
    assert report.columns == schemas.QC_COLUMNS
    assert [out[f"u{i}"]["pass"] for i in range(5)] == [True, False, False, False, True]
    assert all(out[u].score == -99.0 and out[u].forced_logprob == -99.0 and out[u].error and np.isfinite(out[u].snr) for u in ("u1", "u2", "u3"))
    assert out["u0"].score <= 0 and 0 <= out["u0"].start_time < out["u0"].end_time <= 0.48 + 1e-9 and out["u0"].audio_path == "/a.wav" and out["u4"].audio_path == "/a.wav  [0.000-1.000s]"
    assert out["u0"].min_token_score <= out["u0"].mean_token_score
    summary = qc.summary(report).first()
    scores = [out[u].score for u in ("u0", "u4")]
    assert (summary.total, summary.accepted, summary.rejected) == (5, 2, 3) and summary.score_p90 == pytest.approx(np.percentile(scores, 90), abs=1e-4)
    assert qc.summary(report.limit(0)).first().total == 0
    files.write_accepted(report, f"{tmp_path}/out")
    assert sorted(x.value for x in spark.read.text(f"{tmp_path}/out/rejected_utts.txt").collect()) == ["u1", "u2", "u3"]
    parts = [f"{tmp_path}/out/quality_report.csv/{f}" for f in os.listdir(f"{tmp_path}/out/quality_report.csv") if f.endswith(".csv")]
    texts = [x["text"] for p in parts for x in csv.DictReader(open(p, newline="", encoding="utf-8"))]
    assert sorted(texts) == [f"text, {i}" for i in range(5)]


def test_manifest(spark, tmp_path):
    results = spark.createDataFrame([("u1", "é b"), ("r2", "c"), ("u3", "d"), ("r4", "e")], "utt_id string, ref_normalized string")
    seg = spark.createDataFrame([("u1", "r1", 0.5, 5.9004), ("u3", "r3", 0.0, 1.0)], S)
    wav = spark.createDataFrame([("r1", " /a.wav "), ("r2", "/b.wav"), ("r3", "cat x |")], W)
    seconds = spark.createDataFrame([("/b.wav", 2.5)], "path string, seconds double")
    files.write_manifest(joins.manifest_rows(results, seg, wav, seconds), f"{tmp_path}/m")
    lines = {(x := json.loads(r.value))["utt_id"]: x for r in spark.read.text(f"{tmp_path}/m").collect()}
    assert lines["u1"] == {"audio_filepath": "/a.wav", "text": "é b", "utt_id": "u1", "duration": 5.4, "offset": 0.5}
    assert lines["r2"] == {"audio_filepath": "/b.wav", "text": "c", "utt_id": "r2", "duration": 2.5}
    assert lines["u3"]["audio_filepath"] == "" and lines["r4"] == {"audio_filepath": "", "text": "e", "utt_id": "r4", "duration": 0.0}


def test_summary_file(spark, tmp_path):
    df = spark.createDataFrame([("dev", 12345, 10.0, 5.25, 9.999)], "split string, n long, corpus_wer double, corpus_cer double, avg_wer double")
    files.write_summary(df, f"{tmp_path}/s", "ctc", "te")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/s").collect()]
    assert lines[0] == "Decoder: CTC | Language: te" and lines[-1] == "dev            12,345       10.00%        5.25%        10.00%"


# Audio


def wav_bytes(x, rate, channels=1, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(width)
        f.setframerate(rate)
        if width == 2:
            f.writeframes((np.asarray(x) * 32767).astype("<i2").tobytes())
        elif width == 1:
            f.writeframes((np.asarray(x) * 127 + 128).astype(np.uint8).tobytes())
        else:
            raw = (np.asarray(x) * (2**31 - 1)).astype("<i4")
            f.writeframes(raw.tobytes() if width == 4 else raw.view(np.uint8).reshape(-1, 4)[:, 1:].tobytes())
    return out.getvalue()


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_decoding(width):
    x = np.sin(np.arange(400) / 9).reshape(-1, 2)
    back, rate = audio.decode(wav_bytes(x.ravel(), 8000, 2, width))
    assert rate == 8000 and back.shape == (200, 2) and np.abs(back - x).max() < 0.02
    assert audio.header(b"RIFF")[4] and audio.header(wav_bytes(x.ravel(), 8000, 2, width)) == (8000, 2, 200, width, None)


def test_conversion_of_a_tree(spark, tmp_path):
    tone = np.sin(np.arange(8000) / 5) * 0.5
    for name, data in (("a/x.wav", wav_bytes(tone, 8000)), ("b/y.wav", wav_bytes(np.repeat(tone, 2), 16000, 2)), ("b/z.wav", b"junk"), ("w.wav", wav_bytes(tone, 16000))):
        os.makedirs(os.path.dirname(f"{tmp_path}/in/{name}"), exist_ok=True)
        with open(f"{tmp_path}/in/{name}", "wb") as f:
            f.write(data)
    cli.main(["resample", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out"])
    assert audio.header(open(f"{tmp_path}/out/a/x.wav", "rb").read()) == (16000, 1, 16000, 2, None)
    assert audio.header(open(f"{tmp_path}/out/b/y.wav", "rb").read())[:3] == (16000, 1, 8000) and not os.path.exists(f"{tmp_path}/out/b/z.wav")
    assert open(f"{tmp_path}/out/w.wav", "rb").read() == open(f"{tmp_path}/in/w.wav", "rb").read()
    before = os.stat(f"{tmp_path}/out/a/x.wav").st_mtime_ns
    cli.main(["resample", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out"])  # skips what is done
    assert os.stat(f"{tmp_path}/out/a/x.wav").st_mtime_ns == before
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp_path}/in")
    status = {r.path.rsplit("/", 1)[1]: r.status.split(":")[0] for r in audio.convert(content).collect()}
    assert status == {"x.wav": "converted", "y.wav": "converted", "z.wav": "error", "w.wav": "skipped"}


def test_listings(spark, tmp_path):
    for name in ("Audio/a/x.wav", "wav/x.wav", "wav/y.FLAC", "audio_16k/y.flac", "Audio/z.mp3", "other/q.wav", "Audio/b/x.wav"):
        write(f"{tmp_path}/c/{name}", "x")
    listing = audio.files(spark, f"{tmp_path}/c", ".")
    index = {r.basename: r.path.split("/c/")[1] for r in audio.index(listing, f"{tmp_path}/c").collect()}
    assert index == {"x.wav": "Audio/a/x.wav", "y.flac": "audio_16k/y.flac", "y.FLAC": "wav/y.FLAC"}
    assert [r.path.rsplit("/", 1)[1] for r in audio.scan(spark, f"{tmp_path}/c").collect()] == ["x.wav", "x.wav", "z.mp3", "y.flac", "q.wav", "x.wav"]


def test_folder_pairs(spark, tmp_path):
    for name in ("audio/a.wav", "audio/b.wav", "transcripts/b.txt", "transcripts/c.txt"):
        write(f"{tmp_path}/f/{name}", "  words \n")
    pairs = audio.folder_pairs(audio.files(spark, f"{tmp_path}/f/audio", "wav$"), audio.files(spark, f"{tmp_path}/f/transcripts", "txt$"))
    assert [got(joins.matched(pairs, s), "stem") for s in ("both", "audio", "transcript")] == [[("b",)], [("a",)], [("c",)]]
    assert got(audio.read_transcripts(spark, f"{tmp_path}/f/transcripts"), "stem", "transcript") == [("b", "words"), ("c", "words")]


def test_clips_and_backend(spark):
    tone = np.sin(np.arange(16000 * 2) / 20) * 0.5
    contents = spark.createDataFrame([("/a", wav_bytes(tone, 16000)), ("/bad", b"x")], "path string, content binary")
    utterances = spark.createDataFrame([("u1", "/a", 0.5, 1.5), ("u2", "/a", None, None), ("u3", "/bad", None, None), ("u4", "/none", 0.0, 1.0), ("u5", "/a", 9.0, 9.5)], "utt_id string, path string, start double, end double")
    clips = audio.clips(utterances, contents)
    rows = {r.utt_id: r for r in clips.collect()}
    assert rows["u1"].seconds == 1.0 and rows["u2"].seconds == 2.0 and rows["u3"].error and rows["u4"].error and rows["u5"].seconds == 0.0
    assert np.allclose(rows["u1"].wav, tone[8000:24000], atol=1e-3)
    said = {r.utt_id: r for r in backends.marked(backends.transcribe(clips, backends.FakeBackend, "te", batch=3), "[AUDIO_FAILED]").collect()}
    assert len(said["u1"].hypothesis.split()) == 4 and said["u3"].hypothesis == "[AUDIO_FAILED]" and said["u3"].error
    frames = {r.utt_id: r for r in backends.frames(clips, backends.FakeBackend).collect()}
    assert len(frames["u1"].frames) == 12 and len(frames["u1"].frames[0]) == 9


def test_chunks(spark):
    df = spark.range(103).select(F.col("id").alias("k"))
    sizes = {r.chunk: r["count"] for r in audio.chunk_of(df, 4, "k").groupBy("chunk").count().collect()}
    assert sizes == {0: 25, 1: 25, 2: 25, 3: 28}
    assert audio.chunk_of(spark.range(2).select(F.col("id").alias("k")), 8, "k").select("chunk").distinct().count() == 2


def test_streaming_equals_one_table(spark, tmp_path):
    rows = [(f"u{i}", "ab"[i % 2], "one two three", "one two" if i % 3 else None) for i in range(20)]
    for k in range(2):
        spark.createDataFrame(rows[k::2], ingest.INPUT).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        ingest.evaluate_arrivals(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got_rates = got(ingest.corpus_rates(spark.read.parquet(f"{tmp_path}/out/sums")), "split", "n", "n_skipped", "corpus_wer", "corpus_cer")
    whole = corpus_eval.summarize(corpus_eval.evaluate(spark.createDataFrame(rows, ingest.INPUT)), "split")
    assert got_rates == got(whole, "split", "n", "n_skipped", "corpus_wer", "corpus_cer")
    assert spark.read.parquet(f"{tmp_path}/out/results").count() == 20


def test_plans_read_only_what_they_need(spark):
    plan = queries.QUERIES["pair_match"](spark, SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan and "text" not in plan.split("== Physical Plan ==")[1]
    assert signal.RATE == 16000
