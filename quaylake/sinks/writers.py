"""Lakehouse tables on shared storage and the ways results are written.

Tables are Parquet, registered in the session catalog as external tables
under one root folder (bronze, silver, gold and mart databases).  Layouts:

* partitioned by columns of their own (days);
* bucketed: a stored column, `BUCKET`, holds a hash of the merge key and is
  the partition column, so a merge finds the buckets its source falls into and
  reads and rewrites those alone;
* versioned (type 2): current versions are bucketed, closed ones lie in one
  partition a load, which later loads neither read nor write.

The added columns are not part of what `table` returns.  Writes:

* `replace`     new contents of a table.  An unpartitioned one is written
                once, to a new folder, and the table's location is switched to
                it: until then the old contents stay readable, also if the job
                fails.  Partitioned targets are staged (a path cannot be
                overwritten while the same job reads it) and then overwritten
                partition-wise (dynamic mode): only partitions present in the
                new rows change.
* `reload_day`  idempotent daily report: today's `run_date` partition is
                replaced (cleared when today's result is empty).
* `append`      plain append.
* `rebuild`     create-or-replace from a query.
* `merge`       keyed upsert into a table (`operators.merge.upsert`); of a
                bucketed table, or one partitioned by a merge-key column, only
                the partitions the source touches are read and rewritten.
* `merge_scd2`  type-2 load.
* `publish_*`   copies to the mart database: keyed upsert or snapshot.

`reload_day`, `merge` into a bucketed table and switched tables write new
folders and then point the catalog at them.  The folders before stay, for
readers that planned on them, until `vacuum` removes what nothing points at.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.merge import scd2, upsert
from ..session import scratch_path

DATABASES = ("bronze", "silver", "gold", "mart")
# Mart copies of the three facts (the warehouse's DDL), with the mart's own
# column types: dates where the lakehouse keeps strings.
MART_TABLES = {
    "mart.fact_sales_order": schemas.FACT_SALES_ORDER,
    "mart.fact_inventory": schemas.FACT_INVENTORY.replace(
        "last_movement_date string", "last_movement_date date"),
    "mart.fact_shipments": schemas.FACT_SHIPMENTS.replace(
        "promised_delivery_date string", "promised_delivery_date date"),
}

BUCKET, LOAD = "_bucket", "_load"
#: The load partition of current versions.
CURRENT = "current"
_KEYS, _BUCKETS, _COLUMNS = "lake.bucket.keys", "lake.bucket.number", "lake.columns"


@dataclass(frozen=True)
class Layout:
    """How a table is stored: its columns as declared, its partition columns, and, if it is
    bucketed, the key and number of its buckets."""
    columns: tuple[str, ...]
    partitions: tuple[str, ...]
    keys: tuple[str, ...] = ()
    buckets: int = 0

    @property
    def versioned(self) -> bool:
        return LOAD in self.partitions

    def bucket(self, types: dict[str, str]) -> Column:
        """The bucket of a row, from its key in the table's types (a NULL key has one as well)."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(types[k]) for k in self.keys]),
                      F.lit(self.buckets)).cast("int")


class Lakehouse:
    """Catalog databases and tables below `root` (shared storage).

    Tables are named "db.table"; `prefix` is put in front of the database
    name in the catalog so several lakes can live in one session (tests).
    `buckets` is the number of buckets of new bucketed tables: about their
    final size over 1 GB (a table keeps the number it was made with).
    """

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = "",
                 buckets: int = 64):
        self.spark = spark
        self.buckets = buckets
        self.root = (root or scratch_path(spark, "lakehouse")).rstrip("/")
        self.prefix = prefix
        # Overwrites of partitioned tables replace only the partitions written
        # (unpartitioned tables are replaced whole either way).  Set once for
        # the session, never toggled per write, so concurrent writes agree.
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")

    def qualified(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    def _create_db(self, db: str) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.prefix}{db} LOCATION '{self.root}/{db}'")

    # --- DDL --------------------------------------------------------------
    def create_databases(self, names=DATABASES) -> None:
        for db in names:
            self._create_db(db)

    def path(self, name: str) -> str:
        db, table = name.split(".")
        return f"{self.root}/{db}/{table}"

    def create_table(self, name: str, ddl: str, partition_by: list[str] | None = None,
                     bucket_by: list[str] | None = None, versioned: bool = False) -> None:
        """CREATE TABLE IF NOT EXISTS ... USING parquet, in the layout given or, by default, the
        one that `schemas` has for a table of that name.  A versioned table needs `is_current`."""
        db, table = name.split(".")
        self._create_db(db)
        if partition_by is None and bucket_by is None:
            partition_by = schemas.PARTITIONS.get(table, [])
            bucket_by = schemas.BUCKETS.get(name, [])
            versioned = name in schemas.VERSIONED
        parts, properties = list(partition_by or []), ""
        if bucket_by:
            columns = ",".join(f.name for f in StructType.fromDDL(ddl))
            ddl += f", {BUCKET} int"
            parts = [BUCKET]
            if versioned:
                ddl += f", {LOAD} string"
                parts = ["is_current", LOAD, BUCKET]
            properties = (f" TBLPROPERTIES ('{_KEYS}'='{','.join(bucket_by)}', "
                          f"'{_BUCKETS}'='{self.buckets}', '{_COLUMNS}'='{columns}')")
        clause = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.qualified(name)} ({ddl}) USING parquet{clause} "
            f"LOCATION '{self.path(name)}'{properties}")

    def create_all(self) -> None:
        self.create_databases()
        for name, ddl in {**schemas.TABLES, **MART_TABLES}.items():
            self.create_table(name, ddl)

    def list_tables(self, db: str) -> list[str]:
        return sorted(f"{db}.{t.name}"
                      for t in self.spark.catalog.listTables(f"{self.prefix}{db}"))

    def layout(self, name: str) -> Layout:
        listed = self.spark.catalog.listColumns(self.qualified(name))
        parts = tuple(c.name for c in listed if c.isPartition)
        found = {r["key"]: r["value"] for r in self.spark.sql(
            f"SHOW TBLPROPERTIES {self.qualified(name)}").collect()} if BUCKET in parts else {}
        if _KEYS not in found:
            return Layout(tuple(c.name for c in listed), parts)
        return Layout(tuple(found[_COLUMNS].split(",")), parts, tuple(found[_KEYS].split(",")),
                      int(found[_BUCKETS]))

    def table(self, name: str) -> DataFrame:
        stored = self.spark.table(self.qualified(name))
        return stored if BUCKET not in stored.columns else stored.select(*self.layout(name).columns)

    def partition_columns(self, name: str) -> list[str]:
        return list(self.layout(name).partitions)

    # --- folders ----------------------------------------------------------
    def _folder(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _remove(self, path: str) -> None:
        """Delete a folder below this lake's root."""
        fs, where = self._folder(path)
        if not path.startswith(f"{self.root}/"):
            raise ValueError(f"{path} is not below {self.root}")
        fs.delete(where, True)

    def location(self, name: str) -> str:
        """The folder that a table's contents lie in now."""
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.qualified(name)}").collect()
        # After the columns, of which one may have that name.
        return [r["data_type"] for r in rows if r["col_name"] == "Location"][-1]

    def _switch(self, name: str, folder: str, schema) -> None:
        """Let a table's name point at `folder`; the folder before stays until `vacuum`."""
        old = self.location(name) if self.exists(name) else None
        same = old is not None and [(f.name, f.dataType) for f in self.table(name).schema] == [
            (f.name, f.dataType) for f in schema]
        if same:
            self.spark.sql(f"ALTER TABLE {self.qualified(name)} SET LOCATION '{folder}'")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")
            self.spark.catalog.createTable(self.qualified(name), folder, "parquet", schema)
        self.spark.catalog.refreshTable(self.qualified(name))

    def _version_folder(self, name: str) -> str:
        """A new folder for contents of a table (names with `_` are not read as part of it)."""
        return f"{self.path(name)}/_versions/{uuid.uuid4().hex}"

    def _swap(self, name: str, rows: DataFrame, values: list[tuple]) -> None:
        """Replace the partitions `values` by `rows` (all rows fall into them): written to a new
        folder, then the catalog is pointed at each partition's part of it.  A job that ends in
        between leaves partitions as they were; repeating it replaces all of them."""
        folder, parts = self._version_folder(name), self.partition_columns(name)
        (self._distribute(name, rows).write.option("maxRecordsPerFile", 0).partitionBy(*parts).parquet(folder))
        fs, _ = self._folder(folder)
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.qualified(name)}").collect()}
        added = []
        for value in values:
            spec = ", ".join(f"{c} = {_literal(v)}" for c, v in zip(parts, value))
            part = "/".join(f"{c}={_written(v)}" for c, v in zip(parts, value))
            where = f"{folder}/{part}"
            if not fs.exists(self._folder(where)[1]):       # no row is left in it
                fs.mkdirs(self._folder(where)[1])
            if part in known:
                self.spark.sql(f"ALTER TABLE {self.qualified(name)} PARTITION ({spec}) SET LOCATION '{where}'")
            else:
                added.append(f"PARTITION ({spec}) LOCATION '{where}'")
        if added:       # new partitions appear together
            self.spark.sql(f"ALTER TABLE {self.qualified(name)} ADD {' '.join(added)}")
        self.spark.catalog.refreshTable(self.qualified(name))

    def vacuum(self, name: str, keep_seconds: float = 7 * 86_400) -> int:
        """Remove folders of earlier contents that are older than `keep_seconds` and that no
        location of the table points at; returns how many."""
        fs, where = self._folder(f"{self.path(name)}/_versions")
        if not fs.exists(where):
            return 0
        table = self.spark.table(self.qualified(name))
        used = {part for f in [self.location(name), *table.inputFiles()] for part in f.split("/")}
        oldest = self.spark._jvm.System.currentTimeMillis() - keep_seconds * 1000
        gone = [s.getPath() for s in fs.listStatus(where)
                if s.getPath().getName() not in used and s.getModificationTime() <= oldest]
        for path in gone:
            fs.delete(path, True)
        return len(gone)

    # --- writes -----------------------------------------------------------
    def _staged(self, df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = f"{self.root}/_staging/{label}-{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def stage(self, df: DataFrame, label: str = "stage") -> DataFrame:
        """Write `df` to a fresh staging folder on shared storage; read it back."""
        return self._staged(df, label)[0]

    def stage_many(self, frames: dict[str, DataFrame], workers: int = 4) -> dict[str, DataFrame]:
        """Stage independent DataFrames as concurrent jobs (they share the
        executors; small ones no longer wait behind large ones)."""
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=max(1, min(workers, len(frames)))) as pool:
            staged = {n: pool.submit(self.stage, df, n) for n, df in frames.items()}
            return {n: f.result() for n, f in staged.items()}

    def _conform(self, name: str, df: DataFrame) -> DataFrame:
        # insertInto is positional: put columns in table order, cast to table types.
        target = self.spark.table(self.qualified(name)).schema
        layout = self.layout(name)
        if layout.keys:
            types = {f.name: f.dataType.simpleString() for f in target}
            df = df.withColumn(BUCKET, layout.bucket(types))
            if layout.versioned:
                df = df.withColumn(LOAD, F.lit(CURRENT))
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])

    def _distribute(self, name: str, df: DataFrame) -> DataFrame:
        """Group rows by partition value before a partitioned write (few
        files per partition).  A rebalance, not a plain repartition: AQE
        splits a partition value holding many rows over several tasks and
        packs small ones together."""
        parts = self.partition_columns(name)
        return df.hint("rebalance", *parts) if parts else df

    def replace(self, name: str, df: DataFrame) -> None:
        rows = self._conform(name, df)
        if self.partition_columns(name):
            staged, folder = self._staged(rows, name.replace(".", "_"))
            self._distribute(name, staged).write.insertInto(self.qualified(name), overwrite=True)
            self._remove(folder)
        else:
            self._write_and_switch(name, rows)

    def _write_and_switch(self, name: str, df: DataFrame) -> None:
        folder = self._version_folder(name)
        try:
            df.write.parquet(folder)
        except Exception:
            self._remove(folder)
            raise
        self._switch(name, folder, df.schema)

    def append(self, name: str, df: DataFrame) -> None:
        self._conform(name, df).write.insertInto(self.qualified(name), overwrite=False)

    def reload_day(self, name: str, df: DataFrame, run_date: date | str,
                   column: str = "run_date") -> None:
        """Replace the `run_date` partition with `df` (re-runs leave one copy).  The day before
        the swap stays readable; an empty result clears the day."""
        rows = self._conform(name, df.withColumn(column, F.lit(str(run_date)).cast("date")))
        self._swap(name, rows, [(str(run_date),)])

    def rebuild(self, name: str, df: DataFrame) -> None:
        """Create or replace `name` with the rows and schema of `df`: written first, then
        the name is switched to it."""
        self._create_db(name.split(".")[0])
        self._write_and_switch(name, df)

    def _touched(self, name: str, staged: DataFrame, layout: Layout) -> list[int]:
        """The buckets that the rows fall into (as many numbers as the table has buckets at most)."""
        types = {f.name: f.dataType.simpleString() for f in self.spark.table(self.qualified(name)).schema}
        return sorted(r[0] for r in staged.select(layout.bucket(types)).distinct().collect())

    def merge(self, name: str, source: DataFrame, keys: list[str], staged: bool = False, **options) -> None:
        """Upsert `source` into table `name` by `keys` (see `upsert`).  A `staged` source is
        stored already: it is read as it is, not written once more."""
        layout = self.layout(name)
        if layout.keys and set(layout.keys) <= set(keys):
            # Equal keys have equal buckets: read and rewrite the buckets of the source alone.
            rows, folder = (source, None) if staged else self._staged(source, name.replace(".", "_"))
            touched = self._touched(name, rows, layout)
            if touched:
                target = self.spark.table(self.qualified(name)).where(F.col(BUCKET).isin(touched))
                rows = upsert(target.select(*layout.columns), rows, keys, **options)
                self._swap(name, self._conform(name, rows), [(b,) for b in touched])
            if folder:
                self._remove(folder)
            return
        target = self.table(name)
        parts = layout.partitions
        if parts and set(parts) <= set(keys):
            # A match needs equal partition values: read only touched partitions
            # (the semi join lets Spark prune partitions at run time).
            # NULL partitions count as touched when the source has NULLs: the new contents
            # of a partition must hold its old rows, whether or not they match.
            touched = source.select(*[F.col(c).alias(f"_p_{c}") for c in parts]).distinct()
            target = target.join(touched, reduce(lambda a, b: a & b, [
                F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in parts]), "left_semi")
        self.replace(name, upsert(target, source, keys, **options))

    def merge_scd2(self, name: str, source: DataFrame, key: str, compare: list[str],
                   run_ts, null_safe: bool = False) -> None:
        """Type-2 load (see `scd2`).  Of a versioned table only the current versions in the
        source's buckets are read; they are rewritten after the versions that this load closes
        are in a partition of their own.  A load that broke off is repeated with its own
        `run_ts`: it writes the same partition again."""
        layout = self.layout(name)
        if not layout.versioned:
            self.replace(name, scd2(self.table(name), source, key, compare, run_ts, null_safe))
            return
        staged, folder = self._staged(source, name.replace(".", "_"))
        touched = self._touched(name, staged, layout)
        if touched:
            current = self.spark.table(self.qualified(name)).where(
                F.col("is_current") & (F.col(LOAD) == CURRENT) & F.col(BUCKET).isin(touched))
            versions, made = self._staged(scd2(current.select(*layout.columns), staged, key, compare,
                                               run_ts, null_safe), name.replace(".", "_"))
            load = "".join(c if c.isalnum() else "-" for c in str(run_ts))
            closed = versions.where(~F.col("is_current"))
            if not closed.isEmpty():
                rows = self._conform(name, closed).withColumn(LOAD, F.lit(load)).withColumn(BUCKET, F.lit(-1))
                self._swap(name, rows, [(False, load, -1)])
            self._swap(name, self._conform(name, versions.where("is_current")),
                       [(True, CURRENT, b) for b in touched])
            self._remove(made)
        self._remove(folder)

    def publish_upsert(self, name: str, df: DataFrame, keys: list[str], staged: bool = False) -> None:
        """Keyed copy into a mart table (stage rows, if they are not `staged`, then upsert the mart)."""
        rows, folder = (df, None) if staged else self._staged(df, "publish")
        self.merge(name, rows, keys, staged=True, check_duplicates=False)
        if folder:
            self._remove(folder)

    def publish_snapshot(self, name: str, df: DataFrame) -> None:
        """Mart table holds only the latest result."""
        if not self.exists(name):
            self.rebuild(name, df)
        else:
            self.replace(name, df)


def _literal(value) -> str:
    return str(value).lower() if isinstance(value, bool) else f"'{value}'" if isinstance(value, str) else str(value)


def _written(value) -> str:
    """A partition value as Spark writes it into a folder's name (none here needs escaping)."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def row_counts(lake: Lakehouse, names: list[str]) -> DataFrame:
    """Row-count audit over catalog tables (one UNION ALL of counts)."""
    from ..plans.gold import row_count_audit

    return row_count_audit({n: lake.table(n) for n in names})
