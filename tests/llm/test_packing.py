"""Packing: exact round trip of tokens, gapless sequences, and windows near the target proportions."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import packing
from tests.llm.conftest import documents

TEXTS = [
    "Hello, World!  it's   the DAY\x0bof J̌ and İ x",
    "<|ENDOFTEXT|> and <|endoftext|>x",
    "ÉTÉ été é   ΣΑΣ",
    "日本語 \U0001f600 ...!!",
    "",
    None,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@pytest.mark.parametrize("text", TEXTS)
def test_words_give_the_ids_of_the_text(tokenizer, text):
    encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    words = encoder.words(None if text is None else text.encode())
    encoder.learn([words])
    assert encoder.encode(words) == expected_ids(tokenizer, text).tobytes()


@pytest.mark.parametrize("cached", [20, packing.CACHED])
def test_words_of_many_kinds(tokenizer, monkeypatch, cached):
    monkeypatch.setattr(packing, "CACHED", cached)
    rng = random.Random(6)
    letters = "abcXYZ\u00e9\u00df\u0130\u01c5\u03a3\u0301\u65e5\u00aa\u00b2'7.,!#$)("
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(3000)] + ["don't.", "it's,", "x's!", "'s", "..."]
    encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for i in range(0, len(words), 50):
        text = rng.choice((" ", "\n", "\t ")).join(words[i : i + 50])
        found = encoder.words(text.encode())
        encoder.learn([found])
        assert encoder.encode(found) == expected_ids(tokenizer, text).tobytes()


def test_texts_together_give_the_ids_of_each(tokenizer):
    rng = random.Random(9)
    bits = ["a", "B.", "don't,", " ", "  ", "\n", "\t\x0b\x0c\r", "\x1c", "\u00a0", "é", "\u0301", "<|", "日本", "x" * 50, "1,2"]
    texts = [*TEXTS, " ", "\n\n", *("".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(300))]
    encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for i in range(0, len(texts), 50):
        some = texts[i : i + 50]
        got = encoder.coded([None if t is None else t.encode() for t in some])
        assert got == [expected_ids(tokenizer, t).tobytes() for t in some]
    assert encoder.coded([]) == [] and encoder.coded([None]) == [np.array([1], "<u4").tobytes()]


def test_texts_are_encoded_in_parts_of_like_bytes():
    """Texts together have fewer different words; a part is bounded by bytes or is one text, and no row goes."""
    sizes = [0, 10, packing.TEXT_BYTES * 2, 5, 0, packing.TEXT_BYTES - 5, 1, *[1000] * 6000, None]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(sizes))), pa.array([None if n is None else b"x" * n for n in sizes], pa.binary())], names=["doc_id", "text"]
    )
    parts = list(packing._by_bytes(iter([batch.slice(0, 0), batch]), 1))
    assert [i for part in parts for i in part.column(0).to_pylist()] == list(range(len(sizes)))
    held = [sum(map(len, filter(None, part.column(1).to_pylist()))) for part in parts]
    assert all(n < packing.TEXT_BYTES + max(len(t or b"") for t in part.column(1).to_pylist()) for n, part in zip(held, parts, strict=True))
    assert max(len(part) for part in parts) > 1000


def test_every_token_lies_in_one_piece(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, window_sequences=8).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc_id, parts in pieces.items():
        ids, at = expected_ids(tokenizer, texts[doc_id]), 0
        for r in sorted(parts, key=lambda r: r.start):
            piece = ids[r.start : r.start + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece.tobytes()))
            assert r.ids == piece.tolist()
            at += r.length
        assert at == len(ids)
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or number == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))


@pytest.mark.parametrize("chunk_rows", [packing.CHUNK_ROWS, 50])
def test_windows_hold_the_target_proportions(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(packing, "CHUNK_ROWS", chunk_rows)
    monkeypatch.setattr(packing, "BLOCK_WINDOWS", 2)
    rng = random.Random(4)
    rows = [
        (i, "word " * rng.choice((1, 20, 100, 300)) if i else "word " * 9000, "en", rng.choice("aaaaabbc")) for i in range(1500)
    ]
    pieces = packing.pack(documents(spark, rows), sequence=128, window_sequences=32).collect()
    source = {r[0]: r[3] for r in rows}
    window, total = 128 * 32, defaultdict(int)
    for r in pieces:
        total[source[r.doc_id]] += r.length
    all_tokens = sum(total.values())
    so_far, checked = defaultdict(int), 0
    order = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    tokens = 0
    for r in order:
        so_far[source[r.doc_id]] += r.length
        tokens += r.length
        if tokens // window != (tokens - r.length) // window and tokens < all_tokens - window:
            checked += 1
            for s, n in total.items():  # within a window's order a source may be a window early or late, and a packet
                assert abs(so_far[s] - tokens * n / all_tokens) <= window * n / all_tokens + 2 * 128 + 128 * len(total)
    assert checked > 10


def test_targets_change_the_mix(spark):
    docs = documents(spark, [(i, "word " * 50, "en", "ab"[i % 2]) for i in range(400)])
    pieces = packing.pack(docs, sequence=64, window_sequences=16, targets={"a": 3.0, "b": 1.0}).collect()
    first = [r for r in pieces if r.sequence_id < 96]
    share = sum(r.length for r in first if r.doc_id % 2 == 0) / sum(r.length for r in first)
    assert 0.7 < share < 0.8


@pytest.mark.parametrize("alone", [False, True])
def test_small_sources_are_spread_over_the_windows(spark, alone):
    """A source for each document, all of them or half: no window is over twice its size, and each has its share of both."""
    rng = random.Random(8)
    rows = [(i, "word " * rng.choice((5, 40, 100, 300)), "en", f"s{i}" if alone or i % 2 else "large") for i in range(3000)]
    sequence, window_sequences = 128, 32
    size = sequence * window_sequences
    docs = documents(spark, rows)
    coded = packing.tokens(docs)
    lengths = coded.select("row", "source", "n")
    shares = packing._shares(lengths, 3000, sequence, None)
    served = packing._served(packing._queued(lengths, 3000), shares, sequence, size).collect()
    windows, large = defaultdict(int), defaultdict(int)
    for r in served:
        windows[r.turn] += r.length
        large[r.turn] += r.length * (r.source == "large")
    total = sum(windows.values())
    assert sorted(windows) == list(range(1, len(windows) + 1)) and len(windows) >= total // size
    assert max(windows.values()) <= 1.25 * size
    share = sum(large.values()) / total
    for turn in range(1, total // size):  # up to a packet of each kind, and packets that end beyond a window's bound
        assert abs(large[turn] - share * windows[turn]) <= 4 * sequence + 0.1 * size
    pieces = packing.pack(docs, sequence=sequence, window_sequences=window_sequences, with_ids=False).collect()
    assert sum(r.length for r in pieces) == total
    assert sum(r.doc_tokens for r in pieces if r.start == 0) == total
