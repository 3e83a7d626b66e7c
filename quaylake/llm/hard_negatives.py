"""Operator 12: hard negatives by angular triangle filtering.

Vectors become integers, floor(scale * x); a row's score for an anchor is their inner product.
Reference directions are chosen from a bounded, hash-drawn sample (farthest first, by angle), and
each vector's angles to all of them are stored.  For an anchor at angle a and a row at angle b
from a reference, their own angle lies between |a - b| and min(a + b, 2 pi - a - b); all
references together give an interval, its cosines times both norms bound the score.  The bounds
are widened by more than the rounding of angles and norms, so they are safe.

Two passes over a grid of anchor blocks and row blocks, each of bounded size:

1. positives: rows of the anchor's label are scored in the order of their upper bound, until the
   next bound lies below the k-th score;
2. negatives: a positive score p opens the window [least * p, p]; of the rows of other labels,
   only those whose score interval overlaps one of the anchor's windows are scored as integers.

Rows with a null label, id or vector, or with null or non-finite components take no part; only
vectors of one length meet.  Ties go to the smaller id.  Rows are told apart by a row number:
repeated ids are rows of their own, as anchors, positives and negatives.  Zero vectors have score
0 with all.  Scores are exact while inner products (and 100 times those) fit a long.  The choice
of references changes the work, never the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import integer_matrix, integer_vectors, map_batches, stored

_EXACT = float(1 << 53)
#: More than the error of an arc cosine of rounded unit vectors (about 2e-8 beside 0 and pi).
_ANGLE_ERROR = 1e-6


def choose_references(vectors: np.ndarray, number: int) -> np.ndarray:
    """Unit vectors, each the farthest by angle from those before; none of zero vectors alone."""
    norms = np.sqrt((vectors ** 2).sum(1))
    units = vectors[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.empty((0, vectors.shape[1]))
    found, nearest = [0], units @ units[0]
    while len(found) < number and nearest.min() < 1 - 1e-9:
        found.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[found[-1]])
    return units[found]


def angles(vectors: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles to the references by row; those of zero vectors say nothing (and are not used)."""
    norms = np.sqrt((vectors ** 2).sum(1))
    cosines = (vectors @ references.T) / np.maximum(norms, 1e-300)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def score_bounds(norm: float, angle: np.ndarray, norms: np.ndarray,
                 table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score that each row can have for an anchor.  `table` has the
    rows' angles, one reference after the other."""
    nearest, farthest = np.zeros(len(norms)), np.full(len(norms), np.pi)
    for a, b in zip(angle, table):
        np.maximum(nearest, np.abs(b - a), out=nearest)
        both = a + b
        np.minimum(farthest, np.minimum(both, 2 * np.pi - both), out=farthest)
    product = norm * norms
    slack = 1e-9 * product + 1e-6
    low = product * np.cos(np.minimum(farthest + _ANGLE_ERROR, np.pi)) - slack
    return low, product * np.cos(np.maximum(nearest - _ANGLE_ERROR, 0)) + slack


class Cell:
    """The anchors and rows that meet in one cell of the grid."""

    def __init__(self, group: pa.Table, dim: int, references: int):
        group = group.combine_chunks()
        anchors = group.filter(group["anchor"])
        rows = group.filter(pa.compute.invert(group["anchor"]))
        self.anchors = {c: anchors[c].to_numpy() for c in ("row", "vec_id", "label")}
        self.rows = {c: rows[c].to_numpy() for c in ("row", "vec_id", "label")}
        self.scores_of = anchors["scores"].to_pylist()
        self.positives_of = anchors["positives"].to_pylist()
        a, x = integer_matrix(anchors["ints"], dim), integer_matrix(rows["ints"], dim)
        # Floats are exact for integers below 2^53; larger products use integer arithmetic.
        largest = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * dim
        kind = np.float64 if largest < _EXACT else np.int64
        self.a, self.x = a.astype(kind), x.astype(kind)
        self.a_norms = np.sqrt((a.astype(float) ** 2).sum(1))
        self.norms = np.sqrt((x.astype(float) ** 2).sum(1))
        self.a_table = integer_matrix(anchors["angles"], references, "<f8")
        self.table = np.ascontiguousarray(integer_matrix(rows["angles"], references, "<f8").T)
        self.scored = 0

    def bounds(self, at: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(self.a_norms[at], self.a_table[at], self.norms[chosen], self.table[:, chosen])

    def score(self, at: int, chosen: np.ndarray) -> np.ndarray:
        self.scored += len(chosen)
        return (self.x[chosen] @ self.a[at]).astype(np.int64)

    def positives(self, at: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the first k other rows of the anchor's label."""
        open_ = np.flatnonzero((self.rows["label"] == self.anchors["label"][at])
                               & (self.rows["row"] != self.anchors["row"][at]))
        _, upper = self.bounds(at, open_)
        order = np.argsort(-upper, kind="stable")
        open_, upper = open_[order], upper[order]
        places, scores, step = np.empty(0, np.int64), np.empty(0, np.int64), 16 * k
        while len(open_):
            places = np.concatenate([places, open_[:step]])
            scores = np.concatenate([scores, self.score(at, open_[:step])])
            open_, upper, step = open_[step:], upper[step:], step * 4
            best = np.lexsort((self.rows["vec_id"][places], -scores))[:k]
            places, scores = places[best], scores[best]
            if len(scores) == k:
                left = int(np.searchsorted(-upper, -scores[-1], side="right"))
                open_, upper = open_[:left], upper[:left]
        return places, scores

    def negatives(self, at: int, k: int, percent: int):
        """For each positive score of the anchor, places and scores of its first k negatives."""
        tops = self.scores_of[at] or []
        windows = [(-(-percent * p // 100), p) for p in tops]     # 100 n >= percent p, n <= p
        other = np.flatnonzero(self.rows["label"] != self.anchors["label"][at])
        low, upper = self.bounds(at, other)
        wanted = np.zeros(len(other), bool)
        for least, most in set(windows):
            if least <= most:
                wanted |= (upper >= least) & (low <= most)
        chosen = other[wanted]
        scores = self.score(at, chosen)
        order = np.lexsort((self.rows["vec_id"][chosen], -scores))
        chosen, scores = chosen[order], scores[order]
        for place, (least, most) in enumerate(windows):
            first = int(np.searchsorted(-scores, -most, side="left"))
            last = int(np.searchsorted(-scores, -least, side="right"))
            last = min(max(last, first), first + k)
            yield place, chosen[first:last], scores[first:last]


def mine(df: DataFrame, is_anchor: Column, scale: float = 256.0, positives: int = 5,
         negatives: int = 5, percent: int = 80, references: int = 32, sample: int = 2000,
         block_rows: int = 16_384, anchor_rows: int = 4096, least_blocks: int = 12,
         id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         counted: bool = False) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row
    that `is_anchor` (an expression over vec_id) selects and each of its first `positives` rows
    of the same label, the first `negatives` rows of other labels whose score is at least
    `percent` hundredths of the positive's and not above it.  `label` is an expression over the
    table (default its column `label`).  With `counted`, instead (scored, compared): how many
    pairs of anchors and rows of other labels met, and how many of them were scored."""
    spark = df.sparkSession
    named = {"label": (F.col("label") if label is None else label).cast("long")}
    vectors = integer_vectors(df, id_col, vector_col, scale, named).filter(F.col("label").isNotNull())
    vectors = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "mined-vectors")
    sizes = {r["dim"]: (r["n"], r["q"]) for r in vectors.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("q")).collect()}
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    if not sizes:
        return spark.createDataFrame([], "scored long, compared long" if counted else schema)
    chosen, wide, tall = {}, {}, {}
    for dim, (n, q) in sorted(sizes.items()):
        wide[dim], tall[dim] = max(least_blocks, -(-n // block_rows)), max(1, -(-q // anchor_rows))
        draw = F.pmod(F.xxhash64("row", F.lit("reference")), F.lit(max(1, n // sample))) == 0
        drawn = (vectors.filter((F.col("dim") == dim) & draw).orderBy("row").limit(2 * sample)
                 .select("ints").collect())
        chosen[dim] = choose_references(np.array(
            [np.frombuffer(bytes(r["ints"]), "<i8") for r in drawn], float).reshape(len(drawn), dim), references)

    def make_table():
        def step(batch):
            tables = [angles(np.frombuffer(ints, "<i8").astype(float)[None], chosen[dim]).tobytes()
                      for dim, ints in zip(batch.column("dim").to_pylist(), batch.column("ints").to_pylist())]
            return {**{c: batch.column(c) for c in ("row", "vec_id", "label", "dim", "ints")}, "angles": tables}
        return step

    # Read twice by either pass: written once.
    table = stored(map_batches(vectors.select("row", "vec_id", "label", "dim", "ints"),
                               "row long, vec_id long, label long, dim int, ints binary, angles binary",
                               make_table), "mined-angles")
    number = lambda of: F.create_map(*[F.lit(x) for d, b in of.items() for x in (d, b)])[F.col("dim")]
    mine_ = lambda of, salt: F.pmod(F.xxhash64("row", F.lit(salt)), number(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), number(of) - 1))

    def grid(anchors: DataFrame) -> DataFrame:
        asked = (anchors.withColumn("anchor_block", mine_(tall, "anchor"))
                 .withColumn("block", every(wide)).withColumn("anchor", F.lit(True)))
        given = (table.withColumn("scores", F.lit(None).cast("array<long>"))
                 .withColumn("positives", F.lit(None).cast("array<long>"))
                 .withColumn("block", mine_(wide, "row")).withColumn("anchor_block", every(tall))
                 .withColumn("anchor", F.lit(False)))
        return asked.unionByName(given).groupBy("dim", "anchor_block", "block")

    def cell_of(group: pa.Table) -> Cell:
        dim = group["dim"][0].as_py()
        return Cell(group, dim, len(chosen[dim]))

    def longs(columns: dict[str, list]) -> pa.Table:
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in columns.items()})

    def find_positives(group: pa.Table) -> pa.Table:
        cell = cell_of(group)
        out: dict[str, list] = {c: [] for c in ("row", "vec_id", "score")}
        for at in range(len(cell.a)):
            places, scores = cell.positives(at, positives)
            out["row"].append(np.full(len(places), cell.anchors["row"][at]))
            out["vec_id"].append(cell.rows["vec_id"][places])
            out["score"].append(scores)
        return longs(out)

    def find_negatives(group: pa.Table) -> pa.Table:
        cell = cell_of(group)
        out: dict[str, list] = {c: [] for c in (
            "row", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
        compared = 0
        for at in range(len(cell.a)):
            compared += int((cell.rows["label"] != cell.anchors["label"][at]).sum())
            for place, places, scores in cell.negatives(at, negatives, percent):
                like = lambda value: np.full(len(places), value, np.int64)  # noqa: B023, E731
                for c, v in (("row", like(cell.anchors["row"][at])), ("place", like(place)),
                             ("anchor_id", like(cell.anchors["vec_id"][at])),
                             ("positive_id", like(cell.positives_of[at][place])),
                             ("positive_score", like(cell.scores_of[at][place])),
                             ("negative_id", cell.rows["vec_id"][places]), ("negative_score", scores)):
                    out[c].append(v)
        return pa.table({"scored": [cell.scored], "compared": [compared]}) if counted else longs(out)

    none = F.lit(None).cast("array<long>")
    anchors = table.filter(is_anchor)
    near = grid(anchors.withColumn("scores", none).withColumn("positives", none)).applyInArrow(
        find_positives, "row long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    first = (near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
             .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("p"))
             .select("row", F.col("p.score").alias("scores"), F.col("p.vec_id").alias("positives")))
    found = grid(anchors.join(first, "row"))
    if counted:
        return found.applyInArrow(find_negatives, "scored long, compared long").groupBy().agg(
            F.sum("scored").alias("scored"), F.sum("compared").alias("compared"))
    found = found.applyInArrow(find_negatives, "row long, place long, anchor_id long, positive_id long, "
                               "positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))
