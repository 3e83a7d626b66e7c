"""Operator 9: language identification by nearest centroid.

A text's vector holds the counts of its hashed byte bigrams and trigrams (letters in lower
case; everything but letters counts as a blank), damped by a logarithm, weighted by inverse
document frequency and normalised.  Each language has several centroids, found by clustering
its training vectors on the unit sphere; the language of the nearest centroid by cosine wins.
A text whose cosine lies below its language's threshold - a share of a low quantile of the
training texts' cosines - is marked as rejected.

The centroids are fitted on a bounded sample, `sample_per_language` whole texts chosen by a
hash of the id; the hashed dimension bounds the model.  Null texts and texts without a letter
are `und` with score 0 and rejected, and so is everything if no training text has a language.
Ties go to the language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import map_batches

UNKNOWN = "und"
DIMENSION = 4096
_CHUNK = 256

_SYMBOL = np.zeros(256, np.uint32)
for _b in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
    _SYMBOL[_b] = _b
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def ngram_counts(texts: pa.Array, dimension: int = DIMENSION):
    """Yields matrices of hashed n-gram counts, for `_CHUNK` texts at a time."""
    shift = np.uint32(32 - (dimension.bit_length() - 1))
    for first in range(0, len(texts), _CHUNK):
        part = pc.utf8_lower(texts.slice(first, _CHUNK)).to_pylist()
        counts = np.zeros((len(part), dimension), np.float32)
        for row, text in enumerate(part):
            symbols = _SYMBOL[np.frombuffer(b"  " + text.encode() + b"  ", np.uint8)]
            one, two, three = symbols[:-2], symbols[1:-1], symbols[2:]
            pairs = one * _FACTORS[0] + two * _FACTORS[1]
            hashed = np.concatenate([pairs[(one != 0) | (two != 0)],
                                     (pairs + (three + np.uint32(1)) * _FACTORS[2])
                                     [(one != 0) | (two != 0) | (three != 0)]])
            hashed = (hashed ^ (hashed >> np.uint32(15))) * _FACTORS[0] >> shift
            counts[row] = np.bincount(hashed, minlength=dimension)
        yield counts


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k unit centroids of unit vectors; seeds are the vectors farthest from each other."""
    seeds = [0]
    nearest = vectors @ vectors[0]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[seeds[-1]])
    centroids = vectors[seeds]
    for _ in range(rounds):
        owner = (vectors @ centroids.T).argmax(1)
        centroids = unit(np.stack([vectors[owner == c].mean(0) if (owner == c).any()
                                   else centroids[c] for c in range(len(centroids))]))
    return centroids.astype(np.float32)


@dataclass
class Model:
    """Centroids (one row each) with their languages; thresholds by language."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    thresholds: dict[str, float]

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(counts), np.zeros(len(counts))
        cosines = unit(np.log1p(counts) * self.idf) @ self.centroids.T
        best = cosines.argmax(1)
        return ([self.languages[i] for i in best],
                np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0).astype(float))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        id_col: str = "doc_id", sample_per_language: int = 400, centroids: int = 4,
        quantile: float = 0.01, share: float = 0.5, dimension: int = DIMENSION) -> Model:
    """Fit on rows with a language and a text that has a letter."""
    usable = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    usable = usable.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                           F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col)))
                           .alias("draw"))
    sizes = dict(usable.groupBy("lang").count().collect())
    if not sizes:
        return Model(np.ones(dimension, np.float32), np.zeros((0, dimension), np.float32), [], {})
    # A hash below the language's threshold: about the wanted number of texts of each.
    bound = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (
        lang, min(2**63 - 1, int(sample_per_language / n * 2**64) - 2**63))])
    # One text of each id (rows without one are drawn by their text), however often repeated.
    sample = (usable.filter(F.col("draw") <= bound[F.col("lang")]).groupBy("lang", "draw")
              .agg(F.min("text").alias("text")).select("lang", "text"))

    def make():
        def step(batch):
            vectors = [row.astype(np.float16).tobytes()
                       for counts in ngram_counts(batch.column(1), dimension)
                       for row in np.log1p(counts)]
            return {"lang": batch.column(0), "vector": vectors}

        return step

    rows = map_batches(sample, "lang string, vector binary", make).collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], bytes(rows[i][1])))
    damped = np.stack([np.frombuffer(bytes(rows[i][1]), np.float16) for i in order]).astype(np.float32)
    langs = np.array([rows[i][0] for i in order])
    idf = (np.log((1 + len(damped)) / (1 + (damped > 0).sum(0))) + 1).astype(np.float32)
    vectors = unit(damped * idf)
    found, names, thresholds = [], [], {}
    for lang in sorted(set(langs)):
        own = vectors[langs == lang]
        mine = cluster(own, centroids)
        found.append(mine)
        names += [str(lang)] * len(mine)
        thresholds[str(lang)] = share * float(np.quantile((own @ mine.T).max(1), quantile))
    return Model(idf, np.concatenate(found), names, thresholds)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row of `df` all its columns and a struct `lang_id` of lang_pred, score, rejected.

    The model goes to the workers with the task: its size is centroids times dimension."""
    texts = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                      F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)).alias("letters"))
    schema = f"row {texts.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"

    def make():
        def step(batch):
            langs, scores = [], []
            for counts in ngram_counts(pc.fill_null(batch.column(0).field(text_col), ""), len(model.idf)):
                part, cosines = model.predict(counts)
                langs += part
                scores += cosines.tolist()
            letters = batch.column(1).to_pylist()
            langs = [lang if ok else UNKNOWN for lang, ok in zip(langs, letters)]
            scores = [score if ok else 0.0 for score, ok in zip(scores, letters)]
            return {"row": batch.column(0), "lang_pred": langs, "score": scores,
                    "rejected": [lang == UNKNOWN or score < model.thresholds[lang]
                                 for lang, score in zip(langs, scores)]}

        return step

    return map_batches(texts, schema, make)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row."""
    rows = predict(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score", "rejected")
