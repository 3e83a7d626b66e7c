"""Operator 3: exact top-k inner products by pivot-table elimination.

Every vector is turned into integers, floor(scale * x).  A fixed set of pivots is chosen from
a bounded, hash-drawn sample (farthest first), and each vector's distances to all pivots are
computed once: the pivot table.  For a query q and a candidate x the largest difference of
their distances to a pivot is a lower bound of |q - x| (triangle inequality), so

    q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2  <=  (|q|^2 + |x|^2 - bound^2) / 2.

Candidates are evaluated exactly in the order of this upper bound, in growing steps, until the
next upper bound lies below the k-th best score: then no other can enter, ties included.

Queries and candidates meet in a grid of blocks (by a hash of the id), each of bounded size;
the results of the blocks are merged per query.  Only vectors of one length are compared; empty
ones score 0 with each other.  Vectors null or with null or non-finite components take no part,
nor does a row without an id.  Ties go to the smaller id.  Rows are told apart by a row number:
rows that share an id are candidates of each other, and query rows that share one have a list
each (under the same query_id).  Scores are exact while
inner products fit a long.  The pivots' choice changes the work, never the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import integer_matrix, integer_vectors, map_batches, stored

_EXACT = float(1 << 53)


def choose_pivots(vectors: np.ndarray, pivots: int) -> np.ndarray:
    """Farthest-first pivots of a sample; fewer if the sample has fewer distinct vectors."""
    found = [0]
    gap = ((vectors - vectors[0]) ** 2).sum(1)
    while len(found) < pivots and gap.max() > 0:
        found.append(int(gap.argmax()))
        gap = np.minimum(gap, ((vectors - vectors[found[-1]]) ** 2).sum(1))
    return vectors[found]


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((vectors - p) ** 2).sum(1)) for p in pivots], 1)


def search_block(queries: np.ndarray, q_numbers: np.ndarray, q_table: np.ndarray, rows: np.ndarray,
                 ids: np.ndarray, numbers: np.ndarray, table: np.ndarray, k: int):
    """Top k of `rows` for every query, exactly: yields (query's place, places in rows, scores).
    Row numbers tell a query from the candidates; ties go to the smaller id."""
    # Floats are exact for integers below 2^53; larger products use integer arithmetic.
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * rows.shape[1]
    kind = np.float64 if largest < _EXACT else np.int64
    rows, queries = rows.astype(kind), queries.astype(kind)
    wide_rows, wide_queries = rows.astype(float), queries.astype(float)
    norms, q_norms = (wide_rows ** 2).sum(1), (wide_queries ** 2).sum(1)
    for at in range(len(queries)):
        bound = np.zeros(len(rows))
        for p in range(table.shape[1]):
            np.maximum(bound, np.abs(table[:, p] - q_table[at, p]), out=bound)
        upper = (q_norms[at] + norms - bound * bound) / 2
        upper += 1e-9 * (q_norms[at] + norms) + 1e-6       # rounding never hides a candidate
        upper[numbers == q_numbers[at]] = -np.inf          # not the query itself
        places = np.empty(0, np.int64)
        scores = np.empty(0, kind)
        step, open_ = 16 * k, np.flatnonzero(upper > -np.inf)
        while len(open_):
            if len(open_) > step:
                split = np.argpartition(-upper[open_], step)
                now, open_ = open_[split[:step]], open_[split[step:]]
            else:
                now, open_ = open_, open_[:0]
            places = np.concatenate([places, now])
            scores = np.concatenate([scores, rows[now] @ queries[at]])
            best = np.lexsort((ids[places], -scores))[:k]
            places, scores = places[best], scores[best]
            if len(scores) == k:
                open_ = open_[upper[open_] >= scores[-1]]
            step *= 4
        yield at, places, scores


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, pivots: int = 16,
          sample: int = 2000, block_rows: int = 16_384, query_rows: int = 4096,
          least_blocks: int = 12, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows that `is_query` (an expression over vec_id)
    selects, against all rows."""
    spark = df.sparkSession
    vectors = stored(integer_vectors(df, id_col, vector_col, scale,
                                    {"number": F.monotonically_increasing_id()}), "pivot-vectors")
    sizes = {r["dim"]: (r["n"], r["q"]) for r in vectors.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).collect()}
    schema = "query_id long, rank int, vec_id long, score long"
    if not sizes:
        return spark.createDataFrame([], schema)
    chosen, blocks = {}, {}
    for dim, (n, q) in sorted(sizes.items()):
        blocks[dim] = (max(least_blocks, -(-n // block_rows)), max(1, -(-q // query_rows)))
        draw = F.pmod(F.xxhash64("vec_id", "number", F.lit("pivot")), F.lit(max(1, n // sample))) == 0
        drawn = (vectors.filter((F.col("dim") == dim) & draw)
                 .orderBy("vec_id", "ints").limit(2 * sample).select("ints").collect())
        some = drawn or vectors.filter(F.col("dim") == dim).orderBy("vec_id", "ints").limit(1).collect()
        chosen[dim] = choose_pivots(np.stack([np.frombuffer(bytes(r["ints"]), "<i8")
                                              for r in some]).astype(float), pivots)

    def make_table():
        def step(batch):
            tables = [_distances(np.frombuffer(ints, "<i8").astype(float)[None], chosen[dim])
                      .tobytes() for dim, ints in zip(batch.column(1).to_pylist(),
                                                      batch.column(2).to_pylist())]
            return {"vec_id": batch.column(0), "dim": batch.column(1), "ints": batch.column(2),
                    "number": batch.column(3), "distances": tables}
        return step

    table = map_batches(vectors, "vec_id long, dim int, ints binary, number long, distances binary",
                        make_table)
    wide = F.create_map(*[F.lit(x) for d, b in blocks.items() for x in (d, b[0])])[F.col("dim")]
    tall = F.create_map(*[F.lit(x) for d, b in blocks.items() for x in (d, b[1])])[F.col("dim")]
    mine = lambda n, salt: F.pmod(F.xxhash64("vec_id", "number", F.lit(salt)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    asked = (table.filter(is_query).withColumn("row_block", mine(tall, "query"))
             .withColumn("block", every(wide)).withColumn("query", F.lit(True)))
    given = (table.withColumn("block", mine(wide, "row"))
             .withColumn("row_block", every(tall)).withColumn("query", F.lit(False)))
    out_schema = "query_id long, query_number long, vec_id long, score long"

    def cell(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asked_rows = group.filter(group["query"])
        rows = group.filter(pa.compute.invert(group["query"]))
        found: list[tuple] = []
        if asked_rows.num_rows and rows.num_rows:
            dim = rows["dim"][0].as_py()
            ids = rows["vec_id"].to_numpy()
            q_ids, q_numbers = asked_rows["vec_id"].to_pylist(), asked_rows["number"].to_numpy()
            p = len(chosen[dim])
            for at, places, scores in search_block(
                    integer_matrix(asked_rows["ints"], dim), q_numbers,
                    integer_matrix(asked_rows["distances"], p, "<f8"),
                    integer_matrix(rows["ints"], dim), ids, rows["number"].to_numpy(),
                    np.asfortranarray(integer_matrix(rows["distances"], p, "<f8")), k):
                found += [(q_ids[at], q_numbers[at], i, s) for i, s in
                          zip(ids[places].tolist(), scores.astype(np.int64).tolist())]
        columns = list(zip(*found)) or [()] * 4
        return pa.table({name: pa.array(c, pa.int64()) for name, c in
                         zip(("query_id", "query_number", "vec_id", "score"), columns)})

    near = asked.unionByName(given).groupBy("dim", "row_block", "block").applyInArrow(cell, out_schema)
    order = Window.partitionBy("query_number").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
