"""Speech-corpus views over the general tables, so that every operator has input at any scale.

Each has an SQL twin in ``oracles``. Rows that miss on a join, are malformed or
repeat come from the tables' own values, never from dropping rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ctc
from ..operators import audit
from ..sources import kaldi

BLANK, CLASSES = 7, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A table's scan over all cores, where it has fewer parts than there are cores; for costly work on small tables. Counting a scan's parts only plans it."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """utt_id, split, reference, hypothesis (without every seventh word; null, as if the audio had failed, for system turns), whisper (the next turn)."""
    c = spread(table(spark, sf_dir, "conversations")).withColumn("text", F.coalesce("text", F.lit("")))
    following = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("whisper"))
    kept = F.filter(F.split("text", " "), lambda w, i: i % 7 != 6)
    rows = c.join(following, ["conv_id", "turn"], "left")
    return rows.select(F.concat_ws("-", "conv_id", "turn").alias("utt_id"), F.col("role").alias("split"), "turn", F.col("text").alias("reference"), F.when(F.col("role") != "system", F.array_join(kept, " ")).alias("hypothesis"), "whisper")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, as the lines of a file each."""
    d = table(spark, sf_dir, "documents").withColumn("_line", F.split(F.coalesce("text", F.lit("")), "\r\n|\r|\n"))
    return d.select(F.col("doc_id").cast("string").alias("source"), F.posexplode("_line").alias("line_no", "line"))


def segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a segments file per conversation: two turns share a key, and answers lack a field."""
    c = table(spark, sf_dir, "conversations")
    key = F.concat_ws("-", "conv_id", F.floor(F.col("turn") / 2))
    end = F.when(F.col("role") == "user", F.concat(F.lit(" "), (F.col("turn") * 2 + 1.5).cast("string"))).otherwise("")
    line = F.concat(key, F.lit("  rec"), F.col("conv_id"), F.lit(" "), (F.col("turn") * 2 + 0.5).cast("string"), end)
    return c.select(F.col("conv_id").cast("string").alias("source"), F.col("turn").cast("int").alias("line_no"), line.alias("line"))


def duration_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an utt2dur file per conversation; some values are words."""
    c = table(spark, sf_dir, "conversations")
    value = F.when(F.col("role") == "user", (F.length("text") / 16).cast("string")).otherwise(F.col("role"))
    key = F.concat(F.lit("u"), F.floor(F.col("turn") / 3))
    return c.select(F.col("conv_id").cast("string").alias("source"), F.col("turn").cast("int").alias("line_no"), F.concat_ws(" ", key, value).alias("line"))


def corpus() -> Column:
    return F.when(F.col("o_orderstatus") == "P", "corpus_F_cleaned").otherwise(F.concat(F.lit("corpus_"), "o_orderstatus"))


def rec_id() -> Column:
    """A recording id of one of the four families, from a customer; two customers may share one, or differ in the band alone."""
    text = lambda c: F.col(c).cast("string")
    half = F.floor(F.col("c_custkey") / 2).cast("string")
    gender = F.when(F.col("c_acctbal") > 4000, "M").otherwise("F")
    base = (
        F.when(F.col("c_nationkey") < 8, F.concat(half, F.lit("_Nagpur_"), gender, F.lit("_"), text("c_nationkey"), F.lit("_monologue_"), half))
        .when(F.col("c_nationkey") < 14, F.concat(F.lit("bn_IN_"), text("c_nationkey"), F.lit("_"), half, F.lit("_Left")))
        .when(F.col("c_nationkey") < 20, F.concat(F.lit("be_SHA1P_C2_r"), half, F.lit("_s002")))
        .otherwise(F.concat(F.lit("x"), half))
    )
    return F.concat(base, F.when(F.col("c_acctbal") > 7000, "_WB").when(F.col("c_acctbal") > 3000, "_NB").otherwise(""))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("rec_id", rec_id())


def text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus, split, utt_id, transcript from orders; cheap ones are blank."""
    o = table(spark, sf_dir, "orders")
    return o.select(corpus().alias("corpus"), F.col("o_orderpriority").alias("split"), F.col("o_orderkey").cast("string").alias("utt_id"), F.when(F.col("o_totalprice") < 30000, "  ").otherwise(F.col("o_orderpriority")).alias("transcript"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus, split, utt_id, rec_id, start_sec, end_sec from first line items: of several the one of the largest part, supplier, date and price. The lowest priority has none."""
    li = table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    order = F.struct("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    one = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max_by(F.struct("l_discount", "l_quantity"), order).alias("v"))
    o = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), corpus().alias("corpus"), F.col("o_orderpriority").alias("split"))
    rows = one.join(o, "o_orderkey").join(customers(spark, sf_dir).select("c_custkey", "rec_id"), "c_custkey")
    return rows.select("corpus", "split", F.col("o_orderkey").cast("string").alias("utt_id"), "rec_id", F.col("v.l_discount").alias("start_sec"), (F.col("v.l_discount") + F.col("v.l_quantity") - 3).alias("end_sec"))


def entry() -> Column:
    """What wav.scp has for a recording: a path, a bare name, a shell pipe, or a path elsewhere."""
    name = F.concat("rec_id", F.lit(".wav"))
    return (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("/data/"), name)).when(F.col("c_mktsegment") == "BUILDING", name)
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("sox "), name, F.lit(" -t wav - |"))).otherwise(F.concat(F.lit("/old//place/"), name))
    )


def wav_scp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus, split, rec_id, audio_source: recordings of customers not in debt; where there are no segments, one per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), corpus().alias("corpus"), F.col("o_orderpriority").alias("split"))
    rows = o.join(customers(spark, sf_dir).where("c_acctbal >= 0"), "c_custkey")
    rows = rows.withColumn("rec_id", F.when(F.col("split") == "5-LOW", F.col("o_orderkey").cast("string")).otherwise(F.col("rec_id")))
    return rows.withColumn("audio_source", entry()).groupBy("corpus", "split", "rec_id").agg(F.max("audio_source").alias("audio_source"))


def present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path of every file that is where it should be."""
    return customers(spark, sf_dir).where("c_nationkey < 20").select(F.concat(F.lit("/data/"), "rec_id", F.lit(".wav")).alias("path")).distinct()


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus, basename, path of indexed audio; the derived corpus has none of its own."""
    c = customers(spark, sf_dir).where("c_mktsegment <> 'FURNITURE'").select(F.concat("rec_id", F.lit(".wav")).alias("basename")).distinct()
    o = table(spark, sf_dir, "orders").where("o_orderpriority = '5-LOW' and o_totalprice > 100000").select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".wav")).alias("basename")).distinct()
    rows = c.unionByName(o).withColumn("corpus", F.explode(F.array(F.lit("corpus_F"), F.lit("corpus_O"))))
    return rows.select("corpus", "basename", F.concat(F.lit("/audio/"), "corpus", F.lit("/"), "basename").alias("path"))


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    wav = wav_scp(spark, sf_dir)
    whole = audit.with_fallback_index(index(spark, sf_dir), wav)
    return audit.resolve_paths(wav, present(spark, sf_dir), whole, audit.GRAIN)


def utt2spk(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    spk = F.when(F.col("o_totalprice") > 150000, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    return o.where("o_orderstatus <> 'P' or o_totalprice > 60000").select(corpus().alias("corpus"), F.col("o_orderpriority").alias("split"), F.col("o_orderkey").cast("string").alias("utt_id"), spk.alias("spk_id"))


def utt2dur(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_totalprice < 250000")
    return o.select(corpus().alias("corpus"), F.col("o_orderpriority").alias("split"), F.col("o_orderkey").cast("string").alias("utt_id"), (F.floor("o_totalprice") / 1000).alias("duration"))


def waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("wav"))


def scored_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, wav, frames (eight log-softmax rows of eight, blank last), target (up to four ids; some empty, some with ids that can't be), seconds."""
    e = table(spark, sf_dir, "embeddings")
    raw = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda t: F.slice(F.col("embedding"), t * 8 + 1, F.lit(8)))
    raw = F.transform(raw, lambda f: F.transform(f, lambda x: x.cast("double") * 4))
    ids = F.array(*(F.pmod(x, F.lit(7)).cast("int") for x in (F.col("vec_id"), F.floor(F.col("vec_id") / 7), F.col("label"), F.floor(F.col("vec_id") / 49))))
    target = F.slice(ids, 1, (F.col("label") % 5).cast("int"))
    target = F.when(F.col("label") == 8, F.concat(target, F.array(F.lit(BLANK)))).when(F.col("label") == 9, F.array_repeat(F.lit(1), 6)).otherwise(target)
    return e.select("vec_id", F.col("embedding").alias("wav"), F.transform(raw, ctc.log_softmax).alias("frames"), target.alias("target"), F.lit(0.64).alias("audio_duration"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kaldi.text(document_lines(spark, sf_dir))
