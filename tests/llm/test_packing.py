"""Packing: every id once, near-equal windows within the capacity, checksums of the very ids."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from venuelake.llm import packing, position_crc
from venuelake.llm.packing import difference, fill, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_crc_of_spans_and_of_joined_spans():
    rng = np.random.default_rng(2)
    buf = rng.integers(0, 256, 20_000, dtype=np.uint8)
    raw = buf.tobytes()
    size = rng.choice([0, 1, 3, 4, 63, 64, 65, 128, 200, 3000], 400)
    start = rng.integers(0, len(buf) - 4000, 400)
    left = position_crc.crc_spans(buf, start, start + size)
    assert left.tolist() == [zlib.crc32(raw[a : a + n]) for a, n in zip(start, size)]
    more = rng.choice([0, 4, 60, 64, 68, 512, 500], 400)
    right = position_crc.crc_spans(buf, start + size, start + size + more)
    assert position_crc.joined(left, right, more).tolist() == [zlib.crc32(raw[a : a + n + m]) for a, n, m in zip(start, size, more)]


def test_differencing_is_near_the_best_split():
    rng = np.random.default_rng(4)
    choices = np.array(np.unravel_index(np.arange(3**8), (3,) * 8)).T
    worse = 0
    for _ in range(20):
        sizes = rng.integers(1, 100, 8)
        at = difference(sizes, 3)
        loads = np.stack([(sizes * (choices == k)).sum(1) for k in range(3)], 1)
        load = np.bincount(at, weights=sizes, minlength=3)
        assert load.sum() == sizes.sum() and load.max() - loads.max(1).min() <= 30
        worse += load.max() > loads.max(1).min() + 10
    assert worse <= 6
    # The textbook case: differencing 8, 7, 6, 5, 4 in two ways leaves 2.
    assert sorted(np.bincount(difference(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])) == [14, 16]


@pytest.mark.parametrize("sizes", [[820] * 400, [2100] * 300, [4095] * 50, [1] * 5000, [4095, 1], [1], [1500, 1500, 1500] * 60])
def test_windows_are_full_whatever_the_lengths(sizes):
    sizes = np.array(sizes)
    of, start, length, at = fill(sizes, 4096)
    load = np.bincount(at, weights=length)
    assert load.max() <= 4096 and len(load) <= max(1, -(-sizes.sum() // 4096)) * 1.04 + 1
    parts = {}
    for o, s, n in zip(of, start, length):
        parts.setdefault(o, []).append((s, n))
    for o, pieces in parts.items():
        at = 0
        for s, n in sorted(pieces):
            assert s == at and n > 0
            at += n
        assert at == sizes[o]


def check(rows, ids_of, window):
    """Every document's ids in pieces, each window gapless and within the capacity."""
    docs, windows = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    for doc_id, pieces in docs.items():
        texts = sorted(ids_of[doc_id], key=len)
        left = {}
        for r in pieces:
            left.setdefault((r.doc_tokens, r.start, r.length, r.ids_crc32), []).append(r)
        assert sum(r.length for r in pieces) == sum(map(len, texts))
        for ids in texts:
            at = 0
            while at < len(ids):
                n = next(k[2] for k, v in left.items() if v and k[0] == len(ids) and k[1] == at and k[3] == zlib.crc32(np.array(ids[at : at + k[2]], "<u4").tobytes()))
                left[next(k for k, v in left.items() if v and k[0] == len(ids) and k[1] == at and k[2] == n)].pop()
                at += n
        assert not any(left.values())
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window


def test_against_the_library(spark):
    library = Tokenizer.from_file(PATH)
    long = "Some words, of a VERY long text; that goes on. " * 3000
    texts = [(1, "Hello, World!"), (1, "Hello, World!"), (1, "Another text"), (2, None), (3, ""), (None, "no id"), (4, long), (5, "<|endoftext|> It's. é,ẛ̣ x<|startoftext|>.")]
    texts += [(i, "word " * (i * 7 % 300)) for i in range(10, 150)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    ids_of = {}
    for d, t in texts:
        ids_of.setdefault(d, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    rows = pack(docs.repartition(3), PATH, window=1024, keep_ids=True).collect()
    check(rows, ids_of, 1024)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    total = sum(map(len, (x for v in ids_of.values() for x in v)))
    assert len({r.sequence_id for r in rows}) <= -(-total // 1024) + 1
    clash = docs.selectExpr("*", *[f"'x' AS {c}" for c in ("shard", "spread", "length", "start", "crcs", "ids", "offset", "sequence_id")])
    check(pack(clash, PATH).collect(), ids_of, 4096)
    assert pack(docs.limit(0), PATH).collect() == []
    with pytest.raises(ValueError):
        pack(docs, PATH, window=1000)


def test_encoder_store_may_be_emptied(monkeypatch):
    library = Tokenizer.from_file(PATH)
    e = packing.Encoder(PATH)
    monkeypatch.setattr(packing, "STORE_WORDS", 3)
    for text in ("one two three, four.", "five six one. two", "", "three two"):
        ids, count = e.encode([text.encode(), b""], 2)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids + [2, 2] and count.sum() == len(ids)
