"""Arrival-driven ingest: each new order file, or zip drop, is processed exactly once.

A file-source stream over the landing (or drop) folder, run with
``trigger(availableNow=True)``: every start processes the files that arrived
since the last start and stops.  Progress lives in the checkpoint folder on
shared storage, so a restart (or a lost driver) resumes without re-reading.
Each micro-batch is cleaned, de-duplicated and upserted into the silver
order table in `foreachBatch`.  Late rows are simply upserted; no watermark
is needed because no state is kept between batches.

Zip drops stream as `binaryFile` rows (names only): each micro-batch is unpacked, checked,
landed or quarantined and loaded into the three facts as `run_facts` does.  The
checkpoint knows which archives were read, so no list of names is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.merge import upsert
from ..plans import pipeline, refresh, silver
from ..sinks.writers import Lakehouse
from ..sources import files


def order_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of order CSV rows arriving under `folder`."""
    reader = (spark.readStream.schema(schemas.ORDER_CSV)
              .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.csv(folder)


def upsert_orders_batch(lake: Lakehouse, table: str):
    """foreachBatch body: stage the parsed batch, drop corrupt rows, apply the
    rules, keep one row per order key and upsert it into `table`."""

    def run(batch: DataFrame, batch_id: int) -> None:
        staged = lake.stage(batch, f"order-batch-{batch_id}")
        clean = staged.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
        fact = silver.fact_sales_order(silver.valid_orders(silver.flag_orders(clean)))
        lake.merge(table, fact, silver.ORDER_KEYS, check_duplicates=False)
        if table == f"silver.{refresh.ORDERS}":
            refresh.note(lake, refresh.ORDERS, "createddate", fact)

    return run


def run_available(spark: SparkSession, folder: str, lake: Lakehouse, table: str,
                  checkpoint: str, max_files: int | None = None) -> None:
    """Process every file that arrived since the last run, then stop."""
    query = (order_stream(spark, folder, max_files).writeStream
             .foreachBatch(upsert_orders_batch(lake, table))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def drop_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of the zip archives arriving under `folder` (their paths)."""
    schema = spark.read.format("binaryFile").load(folder).schema
    reader = (spark.readStream.format("binaryFile").schema(schema)
              .option("pathGlobFilter", "*.zip"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(folder).select("path")


def load_drops_batch(lake: Lakehouse, landing_root: str, run_ts, stream: str):
    """foreachBatch body: the lines of a batch's archives, unpacked, then landed and loaded.  A
    batch that is run again after a failure has the same name and replaces what it wrote."""

    def run(batch: DataFrame, batch_id: int) -> None:
        lines = files.unpacked(batch)
        if not lines.isEmpty():
            pipeline.load_drop_lines(batch.sparkSession, lake, lines, landing_root, run_ts,
                                     f"{stream}-{batch_id}")

    return run


def run_available_drops(spark: SparkSession, folder: str, lake: Lakehouse, landing_root: str,
                        checkpoint: str, run_ts, max_files: int | None = None) -> int:
    """Process every archive that arrived since the last run, then stop; returns how many
    micro-batches had any."""
    lake.create_all()
    stream = checkpoint.rstrip("/").rsplit("/", 1)[-1]
    query = (drop_stream(spark, folder, max_files).writeStream
             .foreachBatch(load_drops_batch(lake, landing_root, run_ts, stream))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)
