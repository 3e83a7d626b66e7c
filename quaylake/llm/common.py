"""Helpers shared by the training-data operators.

Conventions that hold for every operator of this package:

* The caller names the id and text columns; only those are selected, so extra
  columns of any name (also of the operator's own output names) are no clash.
* A null text counts as an empty one, unless the operator says otherwise.
* Repeated ids and repeated rows are kept: one result row per input row.
* An empty table gives an empty result with the full schema.
* Texts are taken whole.  Arrow batches are bounded by rows and by bytes
  (``spark.sql.execution.arrow.maxBytesPerBatch``), so long texts shorten the
  batch, never the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.session import scratch_path

#: The ASCII white space that separates words (tab, line feed, vertical tab, form feed,
#: carriage return, space); a word is a longest run of anything else.
WORD_SEPARATORS = "\\x20\\x09-\\x0D"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one run's intermediate tables, below the shared folder."""
    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: later steps do not recompute
    it, and a lost executor costs only the tasks it was running."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; -1 for a null id (which so belongs to no fold)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % F.lit(modulus), F.lit(-1))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def map_batches(df: DataFrame, schema: str,
                make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """mapInArrow where `make` builds, once a task, the function from a batch to its columns."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            if batch.num_rows:
                step = step or make()
                columns = step(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float,
                    more: dict[str, Column] | None = None) -> DataFrame:
    """(vec_id, dim, ints, then the `more` columns): the components as floor(scale * x), in
    little-endian 64-bit bytes.  Rows without an id or a vector, or with null or non-finite
    components, are left out; an empty vector has dim 0."""
    v, names = F.col("vector"), list(more or {})
    usable = (df.select(F.col(id_col).cast("long").alias("vec_id"),
                        F.col(vector_col).cast("array<double>").alias("vector"),
                        *[c.alias(name) for name, c in (more or {}).items()])
              .filter(F.col("vec_id").isNotNull() & v.isNotNull()
                      & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))))
    types = dict(usable.dtypes)

    def make():
        def step(batch):
            column = batch.column(1)
            values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False)).astype("<i8")
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
            parts = np.split(values, ends[:-1])
            return {"vec_id": batch.column(0), "dim": [len(p) for p in parts],
                    "ints": [p.tobytes() for p in parts], **{c: batch.column(c) for c in names}}
        return step

    return map_batches(usable, ", ".join(["vec_id long, dim int, ints binary",
                                          *[f"{c} {types[c]}" for c in names]]), make)


def integer_matrix(column: pa.Array, dim: int, dtype: str = "<i8") -> np.ndarray:
    """One row of `dim` numbers for each value of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), dim)


class PieceCache:
    """Memo from a piece of text to its result, in two generations of bounded size.

    `fill` computes results for a list of unseen pieces.  When the young generation is full
    it becomes the old one; pieces met again are carried over, so frequent pieces stay.
    """

    def __init__(self, fill: Callable[[list], Iterable], limit: int = 400_000):
        self.fill, self.limit = fill, limit
        self.young: dict = {}
        self.old: dict = {}

    def table(self, pieces: Iterable) -> dict:
        """A mapping that holds every one of `pieces`."""
        wanted = set(pieces)
        missing = wanted.difference(self.young)
        if missing and len(self.young) + len(missing) > self.limit:
            self.old, self.young = self.young, {}
            missing = wanted
        if missing:
            old, todo = self.old, []
            for piece in missing:
                found = old.get(piece)
                if found is None:
                    todo.append(piece)
                else:
                    self.young[piece] = found
            if todo:
                self.young.update(zip(todo, self.fill(todo)))
        return self.young
