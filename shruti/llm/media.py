"""Media columns: texts as progressive JPEG files, read back into full-resolution RGB tensors.

``encode`` adds a binary column with one lossless file per row; ``tensors``
decodes any progressive JPEG column: scans accumulate into coefficient arrays,
numpy makes the inverse transform, chroma is upsampled, and rows get height,
width and the RGB bytes. ``digest`` checks files and their payload, and
``stored_media`` writes the files to the shared folder and reads them back first.
One pass over the rows each, no shuffle; memory is one batch of at most a few MB
of text, and one image's tensor at a time.

Defined results: a null or empty text is 576 bytes of padding; equal texts give
equal files and features, as all arithmetic on samples is exact; repeated rows
are stored each; an empty table gives no rows; in ``tensors`` a null file gives
null tensors and a damaged one the error's text; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, per_batch, stored, utf8
from .jpeg import Decoder, encode_payload, payload_of

UNIT = 576


def padded(text: bytes) -> bytes:
    """The text with bytes 255 up to a positive multiple of ``UNIT``."""
    return text + b"\xff" * (-len(text) % UNIT if text else UNIT)


def encode(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: a progressive JPEG file that has the padded text in its coefficients."""

    def run(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = utf8(part)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([encode_payload(padded(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(per_batch(run), "doc_id long, n_bytes long, media binary")


def tensors(media: DataFrame) -> DataFrame:
    """doc_id, height, width, rgb (row-major, three bytes a pixel) and error of each file in the column ``media``."""

    def run(batch: pa.RecordBatch):
        for doc, data in zip(column(batch, "doc_id").to_pylist(), column(batch, "media").to_pylist()):
            row: tuple = (None, None, None, None)
            if data is not None:
                try:
                    image = Decoder(data).rgb()
                    row = (image.shape[0], image.shape[1], image.tobytes(), None)
                except (ValueError, KeyError, IndexError, StopIteration) as e:
                    row = (None, None, None, str(e) or type(e).__name__)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((doc, *row), kinds)], names=["doc_id", "height", "width", "rgb", "error"])

    return media.select("doc_id", "media").mapInArrow(per_batch(run), "doc_id long, height int, width int, rgb binary, error string")


def feature(image: np.ndarray) -> str:
    """Size, and per channel mean, spread and mean horizontal step of an RGB tensor."""
    n = image.shape[0] * image.shape[1]
    parts = [f"{image.shape[1]}x{image.shape[0]}"]
    for i in range(3):
        plane = image[:, :, i].astype(np.int64)
        total, squares, steps = int(plane.sum()), int((plane * plane).sum()), int(np.abs(np.diff(plane, axis=1)).sum())
        parts.append(f"{total / n:.4f}/{(squares / n - (total / n) ** 2) ** 0.5 if squares * n > total * total else 0.0:.4f}/{steps / n:.4f}")
    return ",".join(parts)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
TENSOR = ", height int, width int, rgb binary"
#: Bytes of tensors that are handed on together, at most, but for one that is larger.
HANDED = 8 << 20


def digest(media: DataFrame, with_tensor: bool = False) -> DataFrame:
    """What the stored files hold: the payload as read back, the file itself, features of its RGB tensor, and, if asked for, the tensor."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary())[: 11 if with_tensor else 8]
    names = [f.split()[0] for f in (DIGEST + TENSOR).split(", ")][: len(kinds)]

    def run(batch: pa.RecordBatch):
        rows: list[tuple] = []
        held = 0
        for doc, n_bytes, data in zip(*(column(batch, c) for c in ("doc_id", "n_bytes", "media"))):
            data = data.as_py()
            image = Decoder(data)
            payload, rgb = payload_of(image), image.rgb()
            row = (doc.as_py(), n_bytes.as_py(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature(rgb))
            if with_tensor:
                row += (rgb.shape[0], rgb.shape[1], rgb.tobytes())
                if rows and held + rgb.size > HANDED:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
                held += rgb.size
            rows.append(row)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return media.mapInArrow(per_batch(run), DIGEST + (TENSOR if with_tensor else ""))


def stored_media(docs: DataFrame) -> DataFrame:
    """The rows of ``digest`` with tensors, of files that are written to the shared folder and read back."""
    return digest(stored(encode(docs), "media", keep=True), with_tensor=True)
