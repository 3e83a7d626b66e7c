"""Operator 8: quality rules as a learned decision list, in DataFrame expressions only.

Every whole text is described by counts and shares (words, symbols, repeated lines, words in
repeated three-word windows, capitals, ...), all Spark expressions over the row itself, so no
shuffle is needed.  A decision list is learned from labelled documents by sequential covering:
a rule, a conjunction of thresholds, is grown on two thirds of the rows by information gain,
pruned on the last third, and takes the rows it covers out; then the next one is grown, as long
as rules hold on the pruning rows.  The list is emitted as one ordered conditional expression.

The list is fitted on a bounded sample, `sample_rows` labelled documents drawn by a hash of
the id, one row of each; their few numbers each are collected, nothing else.  Documents that also fail the fixed
base rules are never kept.  Null text: no words.  Documents labelled both ways are not learned
from; without labelled rows of both classes the list is empty and keeps what passes the base.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import WORD_SEPARATORS

WORD = f"[^{WORD_SEPARATORS}]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the rules' thresholds are on.
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share",
            "capital_share", "digit_share", "line_words", "stop_share", "bang_share")


def measured(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """`df` with the counts and features of its whole texts, each named with `prefix`."""
    p = prefix
    text, words, lines = (F.col(f"{p}{c}") for c in ("text_", "words_", "lines_"))
    windows, ordered = F.col(f"{p}windows_"), F.col(f"{p}ordered_")
    n = F.col(f"{p}n_words")
    out = (
        df.withColumn(f"{p}text_", F.coalesce(F.col(text_col), F.lit("")))
        .withColumn(f"{p}words_", F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)))
        .withColumn(f"{p}lines_", F.filter(F.split(text, "\n", -1),
                                           lambda line: line.rlike(WORD)))
        .withColumn(f"{p}n_words", F.size(words).cast("long"))
        # One hash for each window of three words; the last two starts have none.
        .withColumn(f"{p}windows_", F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
            F.slice(F.transform(words, lambda w, i: F.xxhash64(
                w, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1), F.size(words) - 2)))
        # Sorted by hash, equal windows are neighbours; only where any window repeats.
        .withColumn(f"{p}ordered_", F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn(f"{p}repeated_", F.filter(ordered, lambda w, i: (
            w["h"] == F.get(ordered, i - 1)["h"]) | (w["h"] == F.get(ordered, i + 1)["h"])))
        .withColumn(f"{p}n_repeat_words", F.when(F.col(f"{p}repeated_").isNull(), F.lit(0)).otherwise(
            F.size(F.array_distinct(F.flatten(F.transform(
                F.col(f"{p}repeated_"), lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2))))))
            .cast("long"))
        .withColumn(f"{p}word_chars", F.char_length(F.array_join(words, "")).cast("long"))
        .withColumn(f"{p}n_symbols", F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn(f"{p}n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
    )
    chars = F.greatest(F.col(f"{p}word_chars"), F.lit(1))
    line_count = F.greatest(F.size(lines), F.lit(1))
    word_count = F.greatest(n, F.lit(1))
    features = {
        "mean_word": F.col(f"{p}word_chars") / word_count,
        "symbol_share": F.col(f"{p}n_symbols") / chars,
        "dup_line_share": F.col(f"{p}n_dup_lines") / line_count,
        "repeat_share": F.col(f"{p}n_repeat_words") / word_count,
        "capital_share": F.regexp_count(text, F.lit("\\p{Lu}")) / chars,
        "digit_share": F.regexp_count(text, F.lit("[0-9]")) / chars,
        "line_words": n / line_count,
        "stop_share": F.regexp_count(text, F.lit("[.,]")) / word_count,
        "bang_share": F.regexp_count(text, F.lit("[!?]")) / word_count,
    }
    for name, value in features.items():
        out = out.withColumn(f"{p}{name}", value.cast("double"))
    return out.drop(*[f"{p}{c}_" for c in ("text", "words", "lines", "windows", "ordered", "repeated")])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        """Which rows of the feature matrix fulfil it."""
        return (values[:, FEATURES.index(self.feature)] > self.threshold) == self.above

    def column(self, prefix: str = "") -> Column:
        value = F.col(f"{prefix}{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _thresholds(values: np.ndarray, bins: int) -> list[Condition]:
    found = []
    for place, feature in enumerate(FEATURES):
        distinct = np.unique(values[:, place])
        cuts = (distinct[1:] + distinct[:-1]) / 2
        if len(cuts) > bins:
            cuts = cuts[np.linspace(0, len(cuts) - 1, bins).astype(int)]
        found += [Condition(feature, above, float(cut)) for cut in cuts for above in (True, False)]
    return found


def _grow(holds: np.ndarray, bad: np.ndarray, longest: int) -> list[int]:
    """Add the condition of the largest information gain until only bad rows are covered.

    `holds` tells by condition and row what holds, `bad` which rows are bad."""
    rule: list[int] = []
    covered = np.ones(len(bad), bool)
    while len(rule) < longest and (covered & bad).any() and (covered & ~bad).any():
        b = (holds & (covered & bad)).sum(1)
        g = (holds & (covered & ~bad)).sum(1)
        share = np.where(b > 0, b / np.maximum(b + g, 1), 1.0)
        gain = b * (np.log2(share) - np.log2((covered & bad).sum() / covered.sum()))
        best = int(gain.argmax())
        if gain[best] <= 1e-9:
            break
        rule.append(best)
        covered &= holds[best]
    return rule


def _worth(holds: np.ndarray, rule: list[int], bad: np.ndarray) -> float:
    covered = holds[rule].all(0)
    b, g = (covered & bad).sum(), (covered & ~bad).sum()
    return (b - g) / (b + g) if b + g else -1.0


def learn(values: np.ndarray, labels: np.ndarray, bins: int = 64, longest: int = 4,
          most: int = 24, least_precision: float = 0.97) -> list[Rule]:
    """Rules that name bad rows, in order, from a feature matrix and labels (1 good, 0 bad).

    A rule that covers good rows as well holds only from `least_precision` on.  The rows of one
    that falls short are set aside, and rules are grown for the others; these must also hold on
    the pruning rows, twice at least."""
    if not len(values):
        return []
    conditions = _thresholds(values, bins)
    if not conditions:
        return []
    holds = np.stack([c.holds(values) for c in conditions])
    bad = labels == 0
    pruning = np.arange(len(values)) % 3 == 0
    left, aside = np.ones(len(values), bool), np.zeros(len(values), bool)
    rules: list[Rule] = []
    while (left & ~aside & bad & ~pruning).any() and len(rules) < most:
        grow, prune = left & ~aside & ~pruning, left & pruning

        def precise(rule: list[int]) -> bool:
            covered = holds[rule].all(0) & left
            return (covered & bad).sum() >= max(1, least_precision * covered.sum())

        rule = _grow(holds[:, grow], bad[grow], longest)
        while len(rule) > 1 and precise(rule[:-1]) and (
                _worth(holds[:, prune], rule[:-1], bad[prune])
                >= _worth(holds[:, prune], rule, bad[prune])):
            rule = rule[:-1]
        if not rule:
            break
        covered = holds[rule].all(0)
        if precise(rule) and (not aside.any() or (covered & prune & bad).sum() >= 2):
            rules.append(tuple(conditions[i] for i in rule))
            left &= ~covered
        else:
            aside |= covered
    return rules


def emitted(rules: list[Rule], prefix: str = "") -> Column:
    """The decision list as one ordered conditional: false for the first rule that holds."""
    kept: Column | None = None
    for rule in rules:
        condition = rule[0].column(prefix)
        for more in rule[1:]:
            condition = condition & more.column(prefix)
        kept = F.when(condition, False) if kept is None else kept.when(condition, False)
    return F.lit(True) if kept is None else kept.otherwise(True)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> list[Rule]:
    """Learn the list from `labels` (id, 1 good / 0 bad) of `docs`."""
    usable = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)))
    number = usable.count()
    draw = F.xxhash64(F.col("id").cast("string"))
    bound = min(2**63 - 1, int(sample_rows / max(number, 1) * 2**64) - 2**63)
    chosen = (usable.filter(draw <= F.lit(bound)).groupBy("id")
              .agg(F.min("label").alias("label"), F.max("label").alias("other"))
              .filter("label = other").select("id", "label"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The sample is bounded, so it may be sent to all tasks.
    # One row of each id, before any is collected: an id may be repeated without bound.
    rows = (measured(texts.join(F.broadcast(chosen), "id"))
            .groupBy("id").agg(F.min(F.struct("label", *FEATURES)).alias("row"))
            .select("id", "row.*").orderBy("id").collect())
    return learn(np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(-1, len(FEATURES)),
                 np.array([r["label"] for r in rows], int))


def judged(df: DataFrame, rules: list[Rule], text_col: str = "text", prefix: str = "") -> DataFrame:
    """`df` with the counts, base_failed and kept."""
    p = prefix
    n = F.col(f"{p}n_words")
    base = (n < 50) | (100 * F.col(f"{p}n_repeat_words") > 50 * n)
    out = (measured(df, text_col, p).withColumn(f"{p}base_failed", base)
           .withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & emitted(rules, p)))
    # A filter on any of these, pushed below the features, would repeat their nested expressions
    # for every use, hundreds of times; below a non-deterministic column no filter is pushed.
    new = [f"{p}{c}" for c in dict.fromkeys((*COUNTS, *FEATURES, "base_failed", "kept"))]
    return out.withColumns({c: F.when(F.spark_partition_id() >= 0, F.col(c)) for c in new})


def kept_documents(df: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows that the rules keep, with the columns of `df`."""
    prefix = "quality_rules_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return (judged(df, rules, text_col, prefix).filter(F.col(f"{prefix}kept"))
            .select(*[F.col(f"`{c}`") for c in df.columns]))
