"""Operator 13: personal data by bootstrapped contextual extraction, in DataFrame expressions only.

Fixed rules name the base spans: e-mail addresses, IP addresses, card numbers and phone numbers.
They are the seeds.  What the rules miss, such as two numbers that run into each other, is found
from the patterns that the seeds induce:

* a shape: the seed's characters with runs of letters and digits folded, and for each run of
  digits its least and greatest length.  The shapes most seeds of a kind have, a bounded list,
  are searched in the texts;
* contexts: the two words before, the two words after, the word before with the word after.

Every occurrence (seeds, what the shapes find, and any other token with a digit or an `@`) is an
edge between its value and each of its patterns.  Values and patterns are scored in turns: a
pattern by the share of its distinct values that are of a kind, a value by its best pattern; a
seed keeps score 1 for its kind.  After the last round, occurrences of seeds outside base spans
and of values whose score reaches `threshold` are added.

Offsets come from splitting a text at a rule's matches: they are the running lengths of what lies
between.  Texts without a digit and without an `@` hold nothing and are not looked at again; the
others are stored once with a row number, so repeated and null ids are rows of their own.  Edges
are distinct and pre-aggregated, so copies of a text or a value without number meet no single
task.  Null and empty texts have no spans.  A span added never overlaps a base span of any kind.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
# What the base rules match.  Possessive repeats match the same and keep no stack;
# a run is tried from its start alone, or where the match before ended.
_LOCAL = "A-Za-z0-9._%+-"
RULES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Any token that may be an identifier.
TOKEN = r"(?<![A-Za-z0-9._%+@-])[A-Za-z._%+-]*+[0-9@][A-Za-z0-9._%+@-]*+"
CONTEXT = 60        # characters on either side in which the words of a context are looked for


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(places, lambda d, i: F.struct(d.cast("int").alias("d"), (i % 2 == 1).alias("odd"))),
        F.lit(0), lambda s, x: s + F.when(x["odd"], F.when(x["d"] > 4, 2 * x["d"] - 9)
                                          .otherwise(2 * x["d"])).otherwise(x["d"]))
    return total % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """Whether a match of the kind's rule holds as a span."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def found(texts: DataFrame, pattern: str, label: str) -> DataFrame:
    """(row, label, start, end, match, before, after): every match of `pattern` in `texts` (row,
    text), in code points, with the text right before and after it."""
    between, at = F.col("between"), Window.partitionBy("row", "label").orderBy("place")
    cut = (texts.filter(F.col("text").rlike(pattern))
           .select("row", F.split("text", pattern, -1).alias("between"),
                   F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("match")))
    each = cut.select("row", F.posexplode(F.arrays_zip(
        F.slice(between, 1, F.size(between) - 1).alias("gap"), F.col("match"),
        F.slice(between, 2, F.size(between) - 1).alias("next"))).alias("place", "m"))
    return (each.select(
        "row", F.lit(label).alias("label"), "place", F.length("m.gap").alias("gap"), F.col("m.match").alias("match"),
        F.right(F.col("m.gap"), F.lit(CONTEXT)).alias("before"),
        F.left(F.col("m.next"), F.lit(CONTEXT)).alias("after"))
        .withColumn("end", F.sum(F.col("gap") + F.length("match")).over(at).cast("long"))
        .select("row", "label", (F.col("end") - F.length("match")).alias("start"), "end", "match", "before", "after"))


def _skeleton(match: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(match, "[0-9]+", "9"), "[A-Za-z]+", "a")


def _value(kind: str, match: Column) -> Column:
    """What makes two occurrences the same identifier."""
    return F.lower(F.regexp_replace(match, r"[\x20().-]", "") if kind in ("card", "phone") else match)


@dataclass(frozen=True)
class Shape:
    """A folded form (`9` a run of digits, `a` one of letters) with its runs' lengths."""
    kind: str
    skeleton: str
    runs: tuple[tuple[int, int], ...]

    @property
    def pattern(self) -> str:
        runs = iter(self.runs)
        return "".join("[0-9]{%d,%d}" % next(runs) if c == "9" else "[A-Za-z]++" if c == "a"
                       else re.escape(c) for c in self.skeleton)


def learn_shapes(base: DataFrame, least_seeds: int, most: int, longest: int = 80) -> list[Shape]:
    """For each kind the up to `most` shapes that most distinct seeds have (ties by name), of
    those that `least_seeds` have at least; forms of over `longest` characters are none."""
    seeds = base.select("label", "match", _skeleton(F.col("match")).alias("skeleton"), "value").filter(
        F.length("skeleton") <= longest)
    order = Window.partitionBy("label").orderBy(F.desc("n"), "skeleton")
    # The exact number of distinct values: first one row a value, then a count of rows.
    top = (seeds.groupBy("label", "skeleton", "value").agg(F.min("match").alias("match"))
           .groupBy("label", "skeleton").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_seeds)
           .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most))
    runs = seeds.select("label", "skeleton", F.posexplode(F.transform(
        F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0)), F.length)).alias("run", "n")).groupBy(
        "label", "skeleton", "run").agg(F.min("n").alias("least"), F.max("n").alias("greatest"))
    rows = (top.join(runs, ["label", "skeleton"], "left").groupBy("label", "place", "skeleton")
            .agg(F.sort_array(F.collect_list(F.struct("run", "least", "greatest"))).alias("runs"))
            .orderBy("label", "place").collect())       # `most` rows a kind
    return [Shape(r["label"], r["skeleton"], tuple((x["least"], x["greatest"]) for x in r["runs"]
                                                   if x["run"] is not None)) for r in rows]


def _outside(spans: DataFrame, of: list[str]) -> DataFrame:
    """The rows of `spans` with rank `n` that overlap none of a smaller rank, by one sweep over a
    row's spans: the spans of one rank and label do not overlap each other."""
    by_start = Window.partitionBy("row", *of).orderBy("start", "end")
    behind = by_start.rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_start.rowsBetween(1, Window.unboundedFollowing)
    first = F.col("n") == 0
    return (spans.withColumn("reached", F.max(F.when(first, F.col("end"))).over(behind))
            .withColumn("reach", F.min(F.when(first, F.col("start"))).over(ahead))
            .filter(~first & ~F.coalesce(F.col("reached") > F.col("start"), F.lit(False))
                    & ~F.coalesce(F.col("reach") < F.col("end"), F.lit(False)))
            .drop("reached", "reach", "n"))


def _patterns(occurrences: DataFrame) -> DataFrame:
    """Distinct (pattern, value): the edges of the graph."""
    fold = lambda c: F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))), "[0-9]+", "9")
    before, after = F.split(F.col("b"), " "), F.split(F.col("a"), " ")
    one_before, one_after = F.element_at(before, -1), F.element_at(after, 1)
    two_before = F.concat_ws(" ", F.slice(before, -F.least(F.size(before), F.lit(2)), 2))
    two_after = F.concat_ws(" ", F.slice(after, 1, 2))
    return (occurrences.withColumn("b", fold(F.col("before"))).withColumn("a", fold(F.col("after")))
            .select("value", F.explode(F.array(
                F.concat(F.lit("shape "), _skeleton("match"), F.lit(" "), F.col("ok").cast("string")),
                F.concat(F.lit("before "), two_before), F.concat(F.lit("after "), two_after),
                F.concat(F.lit("around "), one_before, F.lit(" | "), one_after))).alias("pattern"))
            .distinct())


def scored(edges: DataFrame, seeds: DataFrame, rounds: int, least_seeds: int) -> DataFrame:
    """(value, kind, score) after `rounds` rounds over the graph, of values that are no seeds.

    `seeds` is (value, kind), `edges` distinct (value, pattern)."""
    values = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = seeds.distinct()
    known = seeds.select("value", "kind", F.lit(1.0).alias("score"), F.lit(1).alias("seed"))
    new = known.limit(0)
    for _ in range(rounds):
        # A pattern counts one value more than it has, so that a few values alone prove nothing.
        patterns = (edges.join(known.unionByName(new), "value").groupBy("pattern", "kind")
                    .agg(F.sum("score").alias("sum"), F.sum("seed").alias("seeds"))
                    .filter(F.col("seeds") >= least_seeds).join(values, "pattern")
                    .select("pattern", "kind", (F.col("sum") / (F.col("n") + 1)).alias("score")))
        best = (edges.join(patterns, "pattern").groupBy("value", "kind").agg(F.max("score").alias("score"))
                .join(seeds.select("value").distinct(), "value", "left_anti"))
        new = stored(best.withColumn("seed", F.lit(0)), "pii-scores")
    return new.select("value", "kind", "score")


def extract(df: DataFrame, threshold: float = 0.75, rounds: int = 3, least_seeds: int = 3,
            shapes: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: numbers and digest of the base spans, all spans, and how many were added."""
    text = F.col(text_col)
    docs = stored(df.select(F.col(id_col).cast("long").alias("doc_id"),
                            F.when(text.rlike("[0-9@]"), text).alias("text"),
                            F.monotonically_increasing_id().alias("row")), "pii-texts")
    texts = docs.filter(F.col("text").isNotNull()).select("row", "text")

    def checked(spans: DataFrame, kind: str) -> DataFrame:
        return spans.withColumn("ok", passes(kind, F.col("match"))).withColumn("value", _value(kind, F.col("match")))

    union = lambda frames: reduce(DataFrame.unionByName, frames)
    base = stored(union([checked(found(texts, RULES[k], k), k).filter("ok") for k in KINDS]), "pii-base")
    learned = learn_shapes(base, least_seeds, shapes)
    if learned:
        kinds = [k for k in KINDS if any(s.kind == k for s in learned)]
        edge = "[0-9A-Za-z@]"
        shaped = [checked(found(texts, f"(?<!{edge})(?:" + "|".join(
            s.pattern for s in sorted(learned, key=lambda s: (-len(s.skeleton), s.skeleton)) if s.kind == k)
            + f")(?!{edge})", k), k) for k in kinds]
        tokens = found(texts, TOKEN, "token")
        # A token ends at a letter or digit.
        lead = F.length(F.regexp_extract("match", r"^[._%-]*", 0))
        tail = F.length(F.regexp_extract("match", r"[._%+-]*$", 0))
        tokens = (tokens.withColumn("start", F.col("start") + lead).withColumn("end", F.col("end") - tail)
                  .withColumn("match", F.regexp_replace("match", r"^[._%-]+|[._%+-]+$", "")).filter("start < end")
                  .withColumn("ok", F.lit(False)).withColumn("value", F.lower("match")))
        first = base.withColumn("n", F.lit(0))
        shaped = stored(_outside(first.unionByName(union(shaped).withColumn("n", F.lit(1))), []), "pii-shaped")
        others = _outside(first.unionByName(shaped.withColumn("n", F.lit(0)))
                          .unionByName(tokens.withColumn("n", F.lit(1))), [])
        others = stored(shaped.unionByName(others), "pii-others")
        seeds = base.select("value", F.col("label").alias("kind"))
        edges = stored(_patterns(base.unionByName(others)), "pii-edges")
        order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
        high = (scored(edges, seeds, rounds, least_seeds).filter(F.col("score") >= threshold)
                .select("value", "kind", "score").unionByName(seeds.distinct().withColumn("score", F.lit(1.0)))
                .groupBy("value").agg(F.min_by("kind", F.struct(-F.col("score"), order)).alias("kind")))
        added = others.join(high, "value").select("row", "kind", "start", "end", F.lit(False).alias("base"))
    else:
        added = base.limit(0).select("row", F.col("label").alias("kind"), "start", "end", F.lit(False).alias("base"))
    spans = base.select("row", F.col("label").alias("kind"), "start", "end", F.lit(True).alias("base")).unionByName(added)
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    by_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        number.alias("n"), "start", "end", "kind", "base"))).alias("spans"))
    listed = lambda of: F.array_join(F.transform(of, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    every = F.coalesce(F.col("spans"), F.array().cast("array<struct<n:bigint,start:bigint,end:bigint,kind:string,base:boolean>>"))
    base_spans = F.filter("all", lambda s: s["base"])

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base_spans, lambda s: s["kind"] == kind)).cast("long")

    # Texts that were not looked at have no spans and meet none.
    rows = (docs.filter(F.col("text").isNotNull()).select("row", "doc_id").join(by_row, "row", "left")
            .select("doc_id", "spans").unionByName(docs.filter(F.col("text").isNull()).select(
                "doc_id", F.lit(None).cast(by_row.schema["spans"].dataType).alias("spans"))))
    return (rows.withColumn("all", every).select(
        "doc_id", *[of_kind(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base_spans).cast("binary"), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"),
        (F.size("all") - F.size(base_spans)).cast("long").alias("n_added")))
