"""Incremental reads from relational sources with bookmarks.

A bookmark is the highest value of a source's timestamp column that has been
loaded.  The next run reads only rows above it; the predicate is a plain filter,
so Spark pushes it into the JDBC query (or the Parquet scan).  A transaction may
commit a row with the mark's own time, or an earlier one, after the mark was
read: so a window behind the mark is read again, and `unseen` drops the rows
whose key and time were loaded before.
The new bookmark is the maximum of the rows actually read — never the clock —
and is stored only after the load that used them has been written.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOOKMARK_DDL = "source string, mark timestamp_ntz, updated_at timestamp_ntz"


@dataclass(frozen=True)
class SourceTable:
    """One relational source: its name, primary key, change column, bronze target."""
    name: str
    key: str
    ts_col: str
    target: str


# --- fixed values: the four relational sources of the lakehouse -------------
SOURCES = [
    SourceTable("Customer", "CustomerID", "UpdatedAt", "bronze.customer"),
    SourceTable("Supplier", "SupplierID", "UpdatedAt", "bronze.supplier"),
    SourceTable("Warehouse", "WarehouseID", "UpdatedAt", "bronze.warehouse"),
    SourceTable("Product", "ProductID", "UpdatedAt", "bronze.product"),
]
# ---------------------------------------------------------------------------


#: Parallel range queries of a JDBC read by default.
JDBC_PARTITIONS = 8


def above_mark(df: DataFrame, ts_col: str, mark) -> DataFrame:
    """Rows changed after `mark` (all rows on the first run, mark None)."""
    if mark is None:
        return df
    return df.where(F.col(ts_col) > F.lit(mark).cast(df.schema[ts_col].dataType))


#: How far behind its mark a source is read again by default: longer than its transactions last.
OVERLAP = timedelta(hours=1)


def overlapped(mark: datetime | None, overlap: timedelta = OVERLAP) -> datetime | None:
    """Where the next read starts: `overlap` behind the mark."""
    return None if mark is None else mark - overlap


def unseen(df: DataFrame, loaded: DataFrame, key: str, ts_col: str, start) -> DataFrame:
    """Rows of `df`, read above `start`, whose (key, time) pair is not in `loaded`.  Of `loaded`
    only the pairs above `start` are compared; a row without a key or time counts as not loaded."""
    if start is None:
        return df
    known = above_mark(loaded.select(key, ts_col), ts_col, start)
    return df.join(known, [key, ts_col], "left_anti").select(*df.columns)


def read_jdbc(spark: SparkSession, url: str, table: str, ts_col: str, mark=None,
              properties: dict | None = None, partitions: int = JDBC_PARTITIONS) -> DataFrame:
    """Incremental JDBC read.

    With `partitions` > 1 the read is split into that many parallel range
    queries on the change column: its MIN / MAX above the mark are fetched
    first as one aggregate the database computes (aggregate push-down), and
    become the split bounds.  Every source has a change column, so this works
    for text keys too.
    """
    def reader():
        r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for key, value in (properties or {}).items():
            r = r.option(key, value)
        return r

    if partitions > 1:
        bounds = (above_mark(reader().option("pushDownAggregate", "true").load(), ts_col, mark)
                  .agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first())
        if bounds["lo"] is not None and bounds["lo"] != bounds["hi"]:
            split = (reader().option("partitionColumn", ts_col)
                     .option("lowerBound", str(bounds["lo"]))
                     .option("upperBound", str(bounds["hi"]))
                     .option("numPartitions", str(partitions)))
            return above_mark(split.load(), ts_col, mark)
    return above_mark(reader().load(), ts_col, mark)


class Bookmarks:
    """Bookmark table (source, mark), kept as small Parquet versions below `path`.

    A new version is written beside the old one and counts once it is complete, so a crash at
    any point leaves the last complete version in force."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _folder(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _versions(self) -> list[int]:
        """Numbers of the complete versions, in order."""
        fs, where = self._folder(self.path)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()
                      and fs.exists(self._folder(f"{self.path}/{n}/_SUCCESS")[1]))

    def _read(self) -> DataFrame | None:
        versions = self._versions()
        if not versions:
            return None
        return self.spark.read.schema(BOOKMARK_DDL).parquet(f"{self.path}/v{versions[-1]}")

    def get(self, source: str) -> datetime | None:
        marks = self._read()
        if marks is None:
            return None
        row = marks.where(F.col("source") == source).agg(F.max("mark").alias("m")).first()
        return row["m"] if row else None

    def advance(self, source: str, increment: DataFrame, ts_col: str, run_ts) -> datetime | None:
        """Store max(ts_col) of the loaded increment as the new mark, which never goes back.
        Call after the increment's writes have succeeded."""
        new, mark = increment.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("m")).first()["m"], self.get(source)
        if new is None or (mark is not None and new <= mark):
            return mark
        versions, old = self._versions(), self._read()
        row = self.spark.createDataFrame(
            [(source, new, datetime.fromisoformat(str(run_ts)))], BOOKMARK_DDL)
        rows = row if old is None else old.where(F.col("source") != source).unionByName(row)
        number = versions[-1] + 1 if versions else 1
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/v{number}")
        for stale in versions[:-1]:        # the version before stays for readers
            fs, where = self._folder(f"{self.path}/v{stale}")
            fs.delete(where, True)
        return new
