import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shruti.llm import packing

from .corpora import clashing, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, pieces, size):
    """Pieces restore every document, and sequences have no gap and no overlap. Returns the number of sequences."""
    slow = Tokenizer.from_file(PATH)
    want = []
    for i, t, *_ in rows:
        ids = np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids), size), len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda p: repr((p.doc_id, p.piece, p.start, p.length, p.ids_crc32))
    assert sorted(map(repr, want)) == sorted(map(key, pieces))
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


@pytest.mark.parametrize("size", [2048, 64])
def test_pack(spark, size):
    df, rows = documents(spark)
    out = packing.pack(clashing(df), PATH, size).collect()
    n = check(rows, out, size)
    total = sum(p.length for p in out)
    assert n <= total / size * 1.05 + 1


def test_empty_table_and_ids(spark):
    df, _ = documents(spark)
    assert packing.pack(df.limit(0), PATH).count() == 0
    row = packing.pack(spark.createDataFrame([(1, "hello world")], "doc_id long, text string"), PATH, with_ids=True).first()
    assert zlib.crc32(row.ids) == row.ids_crc32 and row.length * 4 == len(row.ids)


def test_added_tokens_as_tokenizers_has_them(spark):
    rows = list(enumerate(["a<|endoftext|>b", "<|endoftext|>", "a <|endoftext|> b " * 3000, "<|endoftext", "x" * 5000 + "<|endoftext|>"]))
    assert list(packing.encoder(PATH)([rows[0][1]])[0]) == [64, 50256, 65]
    check(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect(), 2048)


def test_encoder_equals_tokenizers():
    slow = Tokenizer.from_file(PATH)
    r = random.Random(2)
    some = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 1500), r.randrange(0x3000, 0xD000), 32, 10])) for _ in range(r.randrange(80))) for _ in range(500)]
    some += [" " * 70, "\n\n  x", "it's 12345 'S", "a" * 3000, "  x", "🙂🙂"]
    assert [list(x) for x in packing.encoder(PATH)(some)] == [e.ids for e in slow.encode_batch(some, add_special_tokens=False)]


def test_fill_bin_replaces_the_smallest():
    # greedily 7 + 2 of 10; 2 gives way to 1 + 2? No: to the pair that fills the gap of 3 exactly
    counts = [0] * 11
    for n in (7, 2, 2, 1):
        counts[n] += 1
    mask = sum(1 << n for n in range(11) if counts[n])
    assert sum(packing.fill_bin(counts, mask, 10)) == 10
    counts = [0] * 101
    for n in (60, 35, 22, 18):
        counts[n] += 1
    assert sorted(packing.fill_bin(counts, sum(1 << n for n in range(101) if counts[n]), 100)) == [18, 22, 60]


def test_plan_places_every_piece_once():
    r = random.Random(3)
    for _ in range(30):
        size = r.choice([10, 50, 200])
        histogram = {n: r.choice([1, 2, 7, 100]) for n in r.sample(range(1, size + 1), r.randrange(1, size // 2))}
        slots, bins = packing.plan(histogram, size)
        seen, loads = set(), {}
        for length, count in histogram.items():
            for rank in range(count):
                row = np.searchsorted(slots.key, length << 40 | rank, "right") - 1
                nth, k = rank - (slots.key[row] & ((1 << 40) - 1)), slots.k[row]
                place = (slots.first_bin[row] + nth // k, slots.offsets[slots.at[row] + nth % k])
                assert place not in seen and place[0] < bins
                seen.add(place)
                loads[place[0]] = loads.get(place[0], 0) + length
        assert max(loads.values()) <= size and len(loads) == bins
        lower = max(-(-sum(n * c for n, c in histogram.items()) // size), sum(c for n, c in histogram.items() if 2 * n > size))
        assert bins <= lower * 1.5 + 2
