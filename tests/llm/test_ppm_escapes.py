"""Operator 2's escapes after words before come from all training texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaylake.llm import ppm_score
from quaylake.llm.common import id_remainder


def test_escapes_do_not_depend_on_blocks(spark):
    """More blocks than were once sampled; every other text repeats itself, so a part of the
    blocks says something else than all."""
    df = spark.range(120).select(F.col("id").alias("doc_id"), F.expr(
        "if(id % 7 < 2, repeat(concat('red fox ', id % 5, ' '), 6), concat_ws(' ', sha2(string(id), 256), 'red', 'fox', id))")
        .alias("text")).union(spark.createDataFrame([(900, None), (901, ""), (902, "one")], "doc_id long, text string"))
    held = id_remainder(F.col("doc_id"), 10) == 0
    one, many = ({r["doc_id"]: r["score"] for r in ppm_score.score(
        df, held, layout=True, words_before=2, docs_per_block=n).collect()} for n in (10_000, 1))
    assert len(one) == 123 and one == pytest.approx(many, abs=1e-9)


@pytest.mark.parametrize("count", [1, 2, 9, 5000])
def test_packed_numbers_come_back(count):
    rng = np.random.default_rng(count)
    for top in (2, 1 << 20, 1 << 63):
        keys = np.unique(rng.integers(0, top, count, np.uint64) + np.uint64(top - 1))
        back = ppm_score._unpacked_keys(ppm_score._packed_keys(keys), len(keys))
        assert back.dtype == np.uint64 and back.tolist() == keys.tolist()
        numbers = rng.integers(0, top, count, np.int64 if top < 1 << 63 else np.uint64).astype(np.int64) >> 1
        numbers = np.abs(numbers)
        assert ppm_score._unpacked(ppm_score._packed(numbers), count).tolist() == numbers.tolist()


def test_hashes_follow_the_words_alone():
    words = ["", "a", "b", "\x00", "a\x00", "1234567", "12345678", "12345678\x00", "123456789", "é" * 31, "x" * 63, "x" * 64,
             "x" * 65, "x" * 700 + "y", "x" * 701, "中文"]
    found = ppm_score.hashed(ppm_score.pa.array(words)).tolist()
    assert len(set(found)) == len(words)
    assert ppm_score.hashed(ppm_score.pa.array(["z" * 9, *words[::-1]]).slice(1)).tolist() == found[::-1]
    lines = ppm_score.Lines(ppm_score.pa.array(["b a\nb " + "x" * 65, "A"]))
    plain = lines.word_hashes.tolist()
    again = ppm_score.Lines(ppm_score.pa.array(["b a\nb " + "x" * 65, "A"]))
    assert len(again.dictionary) == 3 and again.word_hashes.tolist() == plain
    assert plain[0] == plain[2] and plain[1] == plain[4] and len(set(plain)) == 3


@pytest.mark.parametrize("low_bits", [0, 1 << 40])
def test_places_among_sorted_hashes(low_bits):
    """Also where hashes differ only in the bits that hold the places."""
    rng = np.random.default_rng(3)
    for count in (0, 1, 2, 900):
        hashes = rng.integers(0, 64, count, np.uint64) + np.uint64(low_bits)
        first, order = ppm_score._sorted(hashes)
        distinct, places = np.unique(hashes, return_inverse=True)
        assert hashes[order[first]].tolist() == distinct.tolist()
        assert ppm_score._places(hashes).tolist() == places.tolist()


def test_scores_leave_no_copies_of_texts_or_shuffles(spark):
    """Only the blocks hold texts; answers, without words, are what the steps store beside them,
    and what a step shuffled is gone when the next begins."""
    seen = []
    store, spark_stored = ppm_score.stored, ppm_score.common.stored

    def watched(df, name):
        on = spark.conf.get(ppm_score._CLEANUP)
        seen.append((name, on, [f.dataType.simpleString() for f in df.schema if f.name in ("texts", "word", "words")]))
        return spark_stored(df, name)

    before = spark.conf.get(ppm_score._CLEANUP)
    df = spark.range(30).selectExpr("id doc_id", "concat_ws(' ', 'one two', id % 7, 'three') text")
    ppm_score.common.stored = watched
    try:
        ppm_score.score(df, F.col("doc_id") % 10 == 0, layout=True, words_before=2, docs_per_block=7).collect()
    finally:
        ppm_score.common.stored = spark_stored
    assert spark.conf.get(ppm_score._CLEANUP) == before and store is ppm_score.stored
    assert {on for _, on, _ in seen} == {"true"}
    assert [n for n, _, texts in seen if texts] == ["ppm-blocks", "ppm-counts", "ppm-vocabulary"]
    assert [n for n, _, _ in seen if n == "ppm-runs"] == ["ppm-runs"] * 2       # longer runs after the shorter ones
