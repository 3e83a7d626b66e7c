"""Keep one row per key (the ROW_NUMBER() = 1 pattern)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import full_order, sort_column


def keep_one(df: DataFrame, keys: list[str], order: list[str],
             tie_break: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """First row per `keys` under `order`, ties broken by the other columns.

    If only `columns` of it are wanted, rows are cut to the keys and the columns they are sorted
    by, up to the last one wanted: rows that tie in all of these have the same values there.

    Planned by Spark as a window with a group limit of 1: each map task keeps
    only its best row per key before the shuffle on `keys`, so a key holding a
    large share of the rows still moves at most one row per input task.
    """
    spec = full_order(df.columns, keys, order, tie_break)
    if columns is not None:
        names = [s.split()[0] for s in spec]
        upto = max([names.index(c) + 1 for c in columns if c not in keys], default=0)
        df, spec = df.select(*keys, *names[:max(upto, 1)]), spec[:max(upto, 1)]
    w = Window.partitionBy(*keys).orderBy(*[sort_column(s) for s in spec])
    first = (
        df.withColumn("_keep_rank", F.row_number().over(w))
        .where(F.col("_keep_rank") == 1)
        .drop("_keep_rank")
    )
    return first if columns is None else first.select(*columns)
