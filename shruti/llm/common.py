"""Shared plumbing of the training-data operators: tables, scratch space, Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper bounds of one Arrow batch sent to a Python worker.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table of a data folder, with Arrow batches bounded in bytes."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that very long texts never pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or a local one where it is unset and the executors are threads of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Paths that each open scratch has, the innermost last.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored inside goes at the end, but for results stored with ``keep``, which are the enclosing scratch's.

    Dropped frames let Spark's cleaner remove their shuffle files; it is asked to, as an operator may leave many.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        gc.collect()
        spark._jvm.System.gc()


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor never recomputes what lies before it, and
    later readers get pruned columns. The reread frame is deterministic.
    """
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    owner = len(_SCRATCH) - (2 if keep else 1)
    if owner >= 0:
        _SCRATCH[owner].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text", prefix: str = "_") -> list:
    """Two independent 64-bit hashes that identify a text."""
    c = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(c, F.lit(1)).alias(f"{prefix}ta"), F.xxhash64(F.lit(2), c).alias(f"{prefix}tb")]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Words of 64 bits in the filter of ``met``: what is broadcast is 8 MB of numbers at most, at any size.
FILTER_WORDS = 1 << 19


def met(rows: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose hash ``key`` may be in ``wanted``, the other rows), so that only the former are shuffled to meet it.

    A table of bits is broadcast, of bounded size; with more keys than bits it
    lets more rows through, and nothing else changes.
    """
    word, bit, mask = fresh(rows, "_word", "_bit", "_mask")
    where = lambda c: F.pmod(F.shiftrightunsigned(c, 6), F.lit(FILTER_WORDS))
    flag = lambda c: F.expr(f"shiftleft(1L, cast(`{c}` & 63 as int))")
    bits = wanted.select(where(key).alias(word), flag(key).alias(bit)).groupBy(word).agg(F.bit_or(bit).alias(mask))
    marked = rows.withColumn(word, where(key)).join(F.broadcast(bits), word, "left")
    found = F.coalesce(F.col(mask).bitwiseAND(flag(key)) != 0, F.lit(False))
    return tuple(marked.where(x).drop(word, mask) for x in (found, ~found))


def per_batch(fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function from one on single batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = fn(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return run


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of at most ``limit`` in all, or of one item that is longer."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column(batch, name).type) else pa.binary()
    return [x or b"" for x in column(batch, name).cast(kind).to_pylist()]


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's values as strings; null counts as empty."""
    return [x or "" for x in column(batch, name).to_pylist()]
