"""Command line: ``python -m shruti.cli audit|evaluate|kaldi|folder|crosscheck|qc|pairs|resample ...``; thin, the work is in the operators."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jobs
from .functions import ctc
from .functions.recording import DERIVED
from .operators import audit, corpus_eval
from .sinks import files
from .sources import audio, kaldi, tables


def corpora(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names of the folders below the root that start with the prefix, sorted (a listing of folders only)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().getName() for f in found if f.isDirectory() and f.getPath().getName().startswith(prefix))


def _grained(read: DataFrame) -> DataFrame:
    """corpus and split from the file's path."""
    parts = F.split("source", "/")
    return read.withColumns({"corpus": F.element_at(parts, -3), "split": F.element_at(parts, -2)}).drop("source", "line_no")


def audit_root(spark: SparkSession, root: str, prefix: str, splits: list[str]) -> DataFrame:
    """The audit of all corpora below a root, in one plan. Corpora without audio of their own use the one they derive from."""
    names = corpora(spark, root, prefix)
    if not names:
        raise FileNotFoundError(f"no corpora starting with {prefix!r} under {root}")
    read = lambda name: kaldi.lines(spark, [f"{root}/{c}/{s}/{name}" for c in names for s in splits], optional=True)
    wav = _grained(kaldi.wav_scp(read("wav.scp"), need_value=False))
    listed = None
    for c in names:
        for sub in audio.SUBDIRS:
            if kaldi.exists(spark, f"{root}/{c}/{sub}"):
                one = audio.index(audio.files(spark, f"{root}/{c}/{sub}", audio.INDEXED), f"{root}/{c}").withColumn("corpus", F.lit(c)).withColumn("rank", F.lit(audio.SUBDIRS.index(sub)))
                listed = one if listed is None else listed.unionByName(one)
    if listed is None:
        listed = spark.createDataFrame([], "basename string, path string, corpus string, rank int")
    index = listed.groupBy("corpus", "basename").agg(F.min_by("path", "rank").alias("path"))
    present = listed.select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    resolved = audit.resolve_paths(wav, present, audit.with_fallback_index(index, spark.createDataFrame([(c,) for c in names], "corpus string")), audit.GRAIN)
    return audit.audit(_grained(kaldi.text(read("text"))), _grained(kaldi.segments(read("segments"))), resolved, _grained(kaldi.two_column(read("utt2spk"), "utt_id", "spk_id")), _grained(kaldi.utt2dur(read("utt2dur"))))


def factory(name: str):
    """What makes a backend, by ``module:name``; it is imported where it is used, on the executors."""
    module, _, made = name.partition(":")

    def make():
        return getattr(importlib.import_module(module), made)()

    return make


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    one = sub.add_parser("audit", help="coverage of all corpora below a root")
    one.add_argument("--root", required=True)
    one.add_argument("--prefix", default="")
    one.add_argument("--splits", default="train,dev,eval")
    one.add_argument("--out", required=True)
    one = sub.add_parser("evaluate", help="error rates of a CSV with reference and hypothesis")
    one.add_argument("--results", required=True)
    one.add_argument("--out", required=True)
    one.add_argument("--compat-failed-rows", action="store_true")
    for name, what in (("kaldi", "transcripts, error rates and manifests of a corpus' splits"), ("folder", "transcripts and error rates of a folder of pairs"), ("crosscheck", "a third transcript beside each row of a CSV"), ("qc", "agreement of audio and transcripts of a Kaldi folder")):
        one = sub.add_parser(name, help=what)
        one.add_argument("--input", required=True)
        one.add_argument("--out", required=True)
        one.add_argument("--backend", required=True, help="module:name of what makes the model")
        one.add_argument("--language", default="-")
        if name == "kaldi":
            one.add_argument("--splits", default="train,dev,eval")
            one.add_argument("--decoder", default="ctc")
        if name == "folder":
            one.add_argument("--audio-dir", default="audio_16k")
            one.add_argument("--text-dir", default="transcripts")
        if name == "qc":
            one.add_argument("--vocabulary", required=True, help="a file of the language's pieces, one a line")
            one.add_argument("--classes", type=int, help="outputs of the model, the blank among them; by default the pieces and the blank")
            one.add_argument("--languages", help="all languages of a joint model, in order of their blocks")
            one.add_argument("--threshold", type=float, default=jobs.qc.SCORE_THRESHOLD)
            one.add_argument("--min-token", type=float)
    one = sub.add_parser("pairs", help="audio and transcripts of a folder that match by name")
    one.add_argument("--folder", required=True)
    one.add_argument("--out", required=True)
    one = sub.add_parser("resample", help="16 kHz mono copies of a tree of WAV files")
    one.add_argument("--input", required=True)
    one.add_argument("--output", required=True)
    one.add_argument("--dry-run", action="store_true")
    a = top.parse_args(args)
    spark = SparkSession.builder.appName("shruti").getOrCreate()
    if a.command == "audit":
        report = audit_root(spark, a.root.rstrip("/"), a.prefix, a.splits.split(","))
        files.write_csv(report, a.out)
        report.where(~F.col("corpus").rlike(DERIVED)).show(truncate=False)
        audit.totals(report).show()
    elif a.command == "evaluate":
        read = tables.read_csv(spark, a.results, "utt_id, split, reference, hypothesis")
        results = corpus_eval.evaluate(read.withColumn("split", F.coalesce("split", F.lit("all"))))
        files.write_csv(results.drop("edits"), f"{a.out}/results.csv", by=["split"])
        summary = corpus_eval.summarize(results, "split", compat_failed_rows=a.compat_failed_rows)
        files.write_summary(summary, f"{a.out}/summary.txt", "ctc", "-")
        summary.show(truncate=False)
    elif a.command == "kaldi":
        jobs.evaluate_kaldi(spark, a.input.rstrip("/"), a.splits.split(","), a.out, factory(a.backend), a.language, a.decoder).show(truncate=False)
    elif a.command == "folder":
        jobs.evaluate_folder(spark, a.input.rstrip("/"), a.out, factory(a.backend), a.language, a.audio_dir, a.text_dir).show(truncate=False)
    elif a.command == "crosscheck":
        jobs.check_transcripts(spark, a.input, a.out, factory(a.backend), a.language).show(truncate=False)
    elif a.command == "qc":
        pieces = [r.line for r in kaldi.lines(spark, a.vocabulary).orderBy("line_no").collect() if r.line]  # a model's vocabulary
        part = ctc.language_slice(a.classes or len(pieces) + 1, a.languages.split(",") if a.languages else None, a.language if a.languages else None)
        jobs.check_alignment(spark, a.input.rstrip("/"), a.out, factory(a.backend), pieces, a.threshold, a.min_token, part).show(truncate=False)
    elif a.command == "pairs":
        wavs, texts = (audio.files(spark, f"{a.folder}/{d}", p) for d, p in (("audio", r"\.wav$"), ("transcripts", r"\.txt$")))
        files.write_csv(audio.folder_pairs(wavs, texts), a.out)
    else:
        found = audio.scan(spark, a.input)
        if a.dry_run:
            content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(a.input)
            head = audio.first_files(content.join(found.select("path"), "path")).select("path", audio.probe("content").alias("h"))
            head.select("path", "h.*", audio.needs_conversion(F.col("h.sample_rate"), F.col("h.channels")).alias("needs_conversion")).show(truncate=False)
            return
        content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(a.input).where(F.col("path").rlike(audio.SCANNED))
        local = F.regexp_replace("path", "^file:/+", "/")
        out = audio.output_path(local, a.input, a.output)
        if audio.collisions(found.select(out.alias("out")), "out").limit(1).count():
            raise ValueError("several inputs would go to one output file")
        # skip what is there already and fits
        if kaldi.exists(spark, a.output):
            there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(a.output).select(F.regexp_replace("path", "^file:/+", "/").alias("out"), audio.probe("content").alias("h"))
            there = there.where(~audio.needs_conversion(F.col("h.sample_rate"), F.col("h.channels"))).select("out")
            content = content.withColumn("out", out).join(there, "out", "left_anti")
        total = found.count()
        converted = audio.convert(content).withColumn("out", out)
        done = files.write_wavs(converted, "out").groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).collect()  # a row for each status
        n = {r.status: r.n for r in done}
        counts = [("converted", n.get("converted", 0)), ("copied", n.get("skipped", 0)), ("errors", n.get("error", 0)), ("skipped", total - sum(n.values()))]
        spark.createDataFrame(counts, "outcome string, files long").show()


if __name__ == "__main__":
    main()
