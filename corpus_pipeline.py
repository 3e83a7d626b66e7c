"""Corpus pipeline over `documents`: language ID, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to
the shared folder and read again as the next stage's `docs`.  All but the last keep the columns
of their input:

1. `language_id` drops documents that the nearest-centroid model rejects (no letters, or too
   far from every centroid of their language);
2. `quality_rules` drops documents that fail the base rules or the learned decision list;
3. `near_duplicates` keeps of every SimHash group the document with the smallest id;
4. `packing` packs what is left into token sequences and returns the pieces.

Models are fitted on the stage's own input; an empty input gives an empty output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm import langid, packing, rules, simhash
from quaylake.llm.common import id_remainder, read_table, stored
from quaylake.llm.registry import HELD_OUT_LANG

#: Packing has no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    modulus, remainder = HELD_OUT_LANG
    model = langid.fit(docs.filter(id_remainder(F.col("doc_id"), modulus) != remainder))
    return langid.predict(docs, model).filter(~F.col("rejected")).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.kept_documents(docs, rules.fit(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the whole table `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
