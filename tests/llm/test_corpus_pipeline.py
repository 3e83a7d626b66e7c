"""The corpus pipeline, stage by stage, and the registered queries."""

import random
import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quaylake.llm import langid, registry, rules, simhash
from quaylake.llm.common import id_remainder, stored

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def test_stage_names_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "packing"]
    names = entry.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert set(registry.QUERIES) <= set(names) and set(entry.oracle_sql()) <= set(names)


def test_stages(spark, corpus):
    docs = corpus
    fold = id_remainder(F.col("doc_id"), 4)
    model = langid.fit(docs.filter(fold != 2))
    rejected = {r["doc_id"] for r in langid.identify(docs, model).filter("rejected").collect()}
    one = stored(corpus_pipeline.language_id(spark, docs, SF001), "t1")
    assert one.columns == docs.columns
    assert sorted(map(tuple, one.collect())) == sorted(tuple(r) for r in docs.collect() if r["doc_id"] not in rejected)

    learned = rules.fit(one, spark.read.parquet(f"{SF001}/labels.parquet"))
    kept = {r["doc_id"] for r in rules.judged(one, learned).filter("kept").collect()}
    two = stored(corpus_pipeline.quality_rules(spark, one, SF001), "t2")
    assert {r["doc_id"] for r in two.collect()} == kept and two.columns == docs.columns

    firsts = {r["component_id"] for r in simhash.components(two).collect()}
    three = stored(corpus_pipeline.near_duplicates(spark, two, SF001), "t3")
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(firsts) and three.columns == docs.columns

    pieces = corpus_pipeline.pack_sequences(spark, three, SF001).collect()
    covered = {}
    for r in pieces:
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["length"]
        assert covered[r["doc_id"]] <= r["doc_tokens"]
    assert covered == {r["doc_id"]: r["doc_tokens"] for r in pieces} and set(covered) == firsts


def test_stages_on_odd_rows(spark):
    draw = random.Random(1)
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept int"
    rows = [(i, " ".join(f"word{draw.randrange(900)}" for _ in range(80)), "en", None, None, i, 0) for i in range(30)]
    rows += [rows[3], (None, None, None, None, None, None, None), (40, "", "en", "s", 0, 1, 1),
             (None, rows[4][1], None, None, None, 1, 1), (41, "x" * 30_000, "en", "s", 1, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stored(stage(spark, docs, SF001), "odd")
        assert docs.columns == [f.split()[0] for f in schema.split(", ")]
    ids = [r["doc_id"] for r in docs.collect()]
    assert len(ids) == len(set(ids)) and set(range(30)) <= set(ids)
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF001), "none")
        assert empty.count() == 0


def test_held_out_fold(spark, corpus):
    held = {r["doc_id"]: r["held_out"] for r in registry.op9_language_id(spark, SF001).collect()}
    assert sorted(held) == sorted(r["doc_id"] for r in corpus.select("doc_id").collect())
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in held.items())
