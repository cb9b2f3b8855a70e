import hashlib
import os
import random
import zlib

import numpy as np
import pytest

from shruti.llm import jpeg, media

from .corpora import clashing, documents, plain


@pytest.mark.parametrize("n", [0, 1, 377, 378, 379, 576, 5760, 100_000])
def test_payload_round_trip(n):
    data = os.urandom(n)
    image = jpeg.Decoder(jpeg.encode_payload(data))
    assert jpeg.payload_of(image) == data
    assert image.rgb().shape == (image.height, image.width, 3) and image.scans == 9


def test_every_byte_value_and_stuffing():
    data = bytes(range(256)) * 5 + b"\xff" * 4000 + b"\0" * 4000
    assert jpeg.payload_of(jpeg.Decoder(jpeg.encode_payload(data))) == data


def test_damaged_block_is_noticed():
    raw = bytearray(jpeg.encode_payload(b"abc" * 200))
    raw[-10] ^= 16
    with pytest.raises(ValueError):
        jpeg.payload_of(jpeg.Decoder(bytes(raw)))


def plain_rgb(image):
    """The definition of the inverse transform, one block at a time."""
    planes = []
    for c in image.components:
        h, w, _ = c.coefficients.shape
        plane = np.zeros((h * 8, w * 8))
        u = np.arange(8)
        cos = np.cos((2 * u[:, None] + 1) * u[None, :] * np.pi / 16) * np.where(u == 0, np.sqrt(0.5), 1.0) / 2
        for y in range(h):
            for x in range(w):
                block = np.zeros(64)
                block[jpeg.zigzag()] = c.coefficients[y, x] * image.quant[c.quant]
                plane[8 * y : 8 * y + 8, 8 * x : 8 * x + 8] = cos @ block.reshape(8, 8) @ cos.T + 128
        fy, fx = image.rows * image.v * 8 // plane.shape[0], image.columns * image.h * 8 // plane.shape[1]
        planes.append(np.clip(np.rint(plane), 0, 255).repeat(fy, 0).repeat(fx, 1)[: image.height, : image.width])
    if len(planes) == 1:
        return np.stack(planes * 3, 2)
    y, cb, cr = planes
    return np.clip(np.stack([y + 1.402 * (cr - 128), y - 0.344136 * (cb - 128) - 0.714136 * (cr - 128), y + 1.772 * (cb - 128)], 2), 0, 255)


def test_rgb_is_the_transform_by_definition():
    image = jpeg.Decoder(jpeg.encode_payload(os.urandom(3000)))
    assert np.abs(image.rgb() - plain_rgb(image)).max() <= 3  # each channel is rounded up to three times


def java_image(spark, data):
    jvm = spark._jvm
    stream = jvm.java.io.ByteArrayInputStream(data)
    found = jvm.javax.imageio.ImageIO.read(stream)
    w, h = found.getWidth(), found.getHeight()
    pixels = np.array(list(found.getRGB(0, 0, w, h, None, 0, w)), np.int64).reshape(h, w)
    return np.stack([pixels >> 16 & 255, pixels >> 8 & 255, pixels & 255], 2)


def java_jpeg(spark, pixels, progressive=True):
    """A file by the JVM's own encoder."""
    jvm, (h, w) = spark._jvm, pixels.shape[:2]
    image = jvm.java.awt.image.BufferedImage(w, h, 1)
    packed = (pixels[:, :, 0].astype(int) << 16 | pixels[:, :, 1].astype(int) << 8 | pixels[:, :, 2]).ravel().tolist()
    for i, p in enumerate(packed):
        image.setRGB(i % w, i // w, p)
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName("jpeg").next()
    param = writer.getDefaultWriteParam()
    if progressive:
        param.setProgressiveMode(jvm.javax.imageio.ImageWriteParam.MODE_DEFAULT)
    out = jvm.java.io.ByteArrayOutputStream()
    stream = jvm.javax.imageio.ImageIO.createImageOutputStream(out)
    writer.setOutput(stream)
    writer.write(None, jvm.javax.imageio.IIOImage(image, None, None), param)
    stream.flush()
    return bytes(out.toByteArray())


def picture(h, w):
    y, x = np.mgrid[:h, :w]
    return np.stack([x * 255 // w, y * 255 // h, (128 + 100 * np.sin(x / 5) * np.cos(y / 7)).astype(int)], 2).astype(np.uint8)


def test_other_decoders_read_our_files(spark):
    data = jpeg.encode_payload("größer als nötig ".encode() * 200)
    theirs, ours = java_image(spark, data), jpeg.Decoder(data).rgb()
    assert theirs.shape == ours.shape
    # chroma may be smoothed there; luma agrees
    assert abs(theirs.mean() - ours.mean()) < 3


@pytest.mark.parametrize("size", [(16, 16), (37, 53), (64, 40)])
def test_we_read_other_encoders_files(spark, size):
    data = java_jpeg(spark, picture(*size))
    image = jpeg.Decoder(data)
    assert image.scans > 3 and image.rgb().shape == (*size, 3)
    assert np.abs(image.rgb() - plain_rgb(image)).max() <= 3  # each channel is rounded up to three times
    luma = lambda p: p @ np.array([0.299, 0.587, 0.114])
    assert np.abs(luma(image.rgb().astype(float)) - luma(java_image(spark, data))).mean() < 4


def test_sequential_files_are_refused(spark):
    with pytest.raises(ValueError, match="progressive"):
        jpeg.Decoder(java_jpeg(spark, picture(16, 16), progressive=False))


def test_tensors(spark):
    good = jpeg.encode_payload(b"hello")
    rows = {r.doc_id: r for r in media.tensors(spark.createDataFrame([(1, good), (2, None), (3, b"junk"), (4, good[:60])], "doc_id long, media binary")).collect()}
    assert (rows[1].height, rows[1].width, len(rows[1].rgb)) == (16, 16, 768) and rows[1].error is None
    assert rows[2].rgb is None and rows[2].error is None and rows[3].error and rows[4].error


def test_digest(spark):
    df, rows = documents(spark)
    columns = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")
    want = []
    for i, t, *_ in rows:
        raw = (t or "").encode()
        padded = raw + b"\xff" * (-len(raw) % 576) if raw else b"\xff" * 576
        stored = jpeg.encode_payload(padded)
        want.append((i, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]), len(stored), hashlib.sha256(stored).hexdigest()))
    out = media.digest(media.encode(clashing(df)))
    assert plain(out, *columns) == sorted(want, key=repr)
    by_text = {}
    features = {r.doc_id: r.feature for r in out.collect() if r.doc_id is not None}
    for i, t, *_ in rows:
        if i is not None:
            assert by_text.setdefault(t or "", features[i]) == features[i]
    assert media.digest(media.encode(df.limit(0))).count() == 0
    assert len(set(by_text.values())) > 0.9 * len(by_text)


def test_stored_media_keeps_files_and_tensors(spark, monkeypatch):
    monkeypatch.setattr(media, "HANDED", 5000)
    df, rows = documents(spark)
    made = {r.doc_id: r for r in media.encode(df).collect() if r.doc_id is not None}
    digests = {r.doc_id: r.asDict() for r in media.digest(media.encode(df)).collect() if r.doc_id is not None}
    out = media.stored_media(clashing(df))
    got = [r.asDict() for r in out.collect()]
    assert out.inputFiles() and all("llm-media-" in f for f in out.inputFiles())
    assert len(got) == len(rows)
    for r in got:
        rgb = np.frombuffer(r.pop("rgb"), np.uint8).reshape(r.pop("height"), r.pop("width"), 3)
        if r["doc_id"] is not None:
            assert r == digests[r["doc_id"]] and (rgb == media.Decoder(made[r["doc_id"]].media).rgb()).all()
        parts = r["feature"].split(",")
        assert parts[0] == f"{rgb.shape[1]}x{rgb.shape[0]}"
        for plane, values in zip(np.moveaxis(rgb.astype(float), 2, 0), parts[1:]):
            want = (plane.mean(), plane.std(), np.abs(plane[:, 1:] - plane[:, :-1]).sum() / plane.size)
            assert np.allclose([float(v) for v in values.split("/")], want, atol=1e-3)
    assert media.stored_media(df.limit(0)).count() == 0


def test_many_random_sizes():
    r = random.Random(5)
    for _ in range(50):
        data = r.randbytes(r.randrange(20000))
        assert jpeg.payload_of(jpeg.Decoder(jpeg.encode_payload(data))) == data
