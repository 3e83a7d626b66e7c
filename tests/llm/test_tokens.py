"""Operators 1, 5 and 6: tokenizers, against the libraries; packing, against its rules."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from quaylake.llm import bpe_codec, packing, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
COUNTS = P.path("byte_bpe_50k.json")
WORDS = P.path("word_bpe_49k.json")
PARTS = ["a", "B", "é", "Σ", "ß", "İ", "ſ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85",
         "\xa0", "'s", "'", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "1", "½", ".", ",",
         "###", "中文", "😀", "́", "word", "the", " of", "tion", "\x00", "-"]
LONG = ["a" * 20_000, "ab" * 9000, " " * 9000, "\n" * 5000 + "x", "é" * 7000, "thnterinat" * 2500]


def texts(n=1500, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(n)] + LONG


@pytest.fixture(scope="module")
def tiktokens():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with the results' names."""
    some = [(i, t) for i, t in enumerate(texts(60))]
    some += [(None, "no id"), (5, None), (5, None), (7, ""), (3, some[3][1]), (3, some[3][1])]
    return some, spark.createDataFrame(
        [(i, t, "x", 1, 2) for i, t in some],
        "doc_id long, text string, n_tokens string, ids int, length long").repartition(3)


def test_codec_equals_library(tiktokens):
    codec = bpe_codec.codec(RANKS, P.PATTERN)
    for text in texts():
        ids = tiktokens.encode_ordinary(text)
        assert codec.encode(text) == ids
        assert codec.decode(ids) == text.encode()


def test_compatible_is_what_merges_say():
    codec = bpe_codec.Codec(bpe_codec.load_ranks(RANKS), P.PATTERN, memo_limit=50)
    draw = random.Random(1)
    for _ in range(300):
        a, b = draw.choices(range(50_256), k=2)
        merged = codec.merge(codec.token[a] + codec.token[b])
        assert codec.compatible(a, b) == (merged == [a, b])
        assert codec.encode_pretoken(codec.token[a] + codec.token[b]) == (
            [codec.ranks[codec.token[a] + codec.token[b]]]
            if codec.token[a] + codec.token[b] in codec.ranks else merged)


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        bpe_codec.Codec({b"a": 0}, P.PATTERN)


def test_round_trip_digests(rows, tiktokens):
    given, df = rows
    want = []
    for i, t in given:
        ids = tiktokens.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe_codec.round_trip_digests(df, RANKS, P.PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ids = {r["doc_id"]: r["ids"] for r in bpe_codec.encode_documents(df, RANKS, P.PATTERN).collect()}
    assert ids[0] == tiktokens.encode_ordinary(given[0][1])


def test_counts_equal_library(rows):
    library = Tokenizer.from_file(COUNTS)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    counter = token_counts.counter(COUNTS, P.PATTERN)
    for text in texts():
        assert counter.count(text) == count(text)
    given, df = rows
    got = [tuple(r) for r in token_counts.token_counts(df, COUNTS, P.PATTERN, limit=20).collect()]
    want = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 20) for i, t in given]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_whole_tokens_encode_alone():
    counter = token_counts.counter(COUNTS, P.PATTERN)
    assert len(counter.whole) > 30_000 and "<|endoftext|>" not in counter.whole
    some = random.Random(2).sample(sorted(counter.whole), 300)
    assert all(len(counter.tokenizer.encode(s, add_special_tokens=False).ids) == 1 for s in some)


def test_word_encoder_equals_library():
    library = Tokenizer.from_file(WORDS)
    encoder = packing.word_encoder(WORDS)
    for text in texts():
        assert encoder.encoded(pa.array([text]))[0].tolist() == library.encode(
            text, add_special_tokens=False).ids


@pytest.mark.parametrize("tokens", [1, 2, 5, 100, 1365, 2047, 2048, 2049, 4095, 4096, 4097, 30_000])
def test_cuts_are_whole_and_fit(tokens):
    pieces = packing.cut_lengths(tokens, 4096, 0.02)
    assert sum(n for _, n in pieces) == tokens
    assert all(0 < n and k * n <= 4096 for k, n in pieces)
    assert all((4096 // k - n) <= 0.02 * (4096 // k) for k, n in pieces)


def test_packing(rows):
    given, df = rows
    library = Tokenizer.from_file(WORDS)
    ids = defaultdict(list)
    for i, t in given:
        ids[i].append(np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
    pieces = packing.pack(df, WORDS, capacity=256).collect()
    by_sequence, tokens = defaultdict(list), defaultdict(int)
    for r in pieces:
        assert any(zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
                   and len(x) == r["doc_tokens"] for x in ids[r["doc_id"]])
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        tokens[r["doc_id"]] += r["length"]
    assert tokens == {i: sum(map(len, x)) for i, x in ids.items()}
    padding = 0
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 256
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding < 0.1 * sum(tokens.values())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_codec.round_trip_digests(none, RANKS, P.PATTERN).count() == 0
    assert token_counts.token_counts(none, COUNTS, P.PATTERN).columns == [
        "doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert packing.pack(none, WORDS).count() == 0
