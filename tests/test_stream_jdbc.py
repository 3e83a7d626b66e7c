"""Arrival-driven stream (restart processes only new files) and JDBC bookmarks."""

import contextlib
import datetime as dt
import io
import os
import uuid

from pyspark.sql import functions as F

from quaylake import schemas
from quaylake.sinks.writers import Lakehouse
from quaylake.sources.incremental import Bookmarks, read_jdbc
from quaylake.streaming.ingest import run_available

HEADER = ",".join(schemas.EXPECTED_COLUMNS["sales_orders"])


def csv(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(HEADER + "\n" + "\n".join(lines) + "\n")


def test_stream_restart_reads_only_new_files(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.create_table("silver.fact_sales_order", schemas.FACT_SALES_ORDER)
    row = "{o},1,2024-01-0{d} 00:00:00,2024-01-0{p} 00:00:00,A,{q},1.5,0.1,{c},8,s1,w1"
    csv(f"{workdir}/in/a.csv", [row.format(o="A", d=1, p=2, q=1, c=1),
                                row.format(o="B", d=1, p=3, q=2, c=1),   # same key, later
                                row.format(o="C", d=2, p=1, q=3, c=2),   # invalid date order
                                "broken,line"])
    args = (spark, f"{workdir}/in", lake, "silver.fact_sales_order", f"{workdir}/ckpt")
    run_available(*args)
    first = {r["salesordernumber"]: r["quantity"] for r in lake.table("silver.fact_sales_order").collect()}
    assert first == {"A": 1}, "earliest line per key; invalid and corrupt rows dropped"
    run_available(*args)   # nothing new: table unchanged
    assert lake.table("silver.fact_sales_order").count() == 1
    csv(f"{workdir}/in/b.csv", [row.format(o="D", d=1, p=2, q=9, c=1),
                                row.format(o="E", d=3, p=4, q=4, c=3)])
    run_available(*args)
    after = {r["salesordernumber"]: r["quantity"] for r in lake.table("silver.fact_sales_order").collect()}
    assert after == {"D": 9, "E": 4}, "second drop updates the key and adds a new one"


def test_jdbc_incremental_with_bookmark(spark, workdir):
    url = f"jdbc:derby:memory:b{uuid.uuid4().hex};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    src = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, dt.datetime(2024, 1, 3))],
        "Id int, UpdatedAt timestamp")
    src.write.jdbc(url, "Thing", mode="overwrite", properties=props)
    marks = Bookmarks(spark, f"{workdir}/marks")
    assert marks.get("Thing") is None
    first = read_jdbc(spark, url, "Thing", "UpdatedAt", None, props)
    assert first.count() == 3
    marks.advance("Thing", first, "UpdatedAt", "2024-01-03 12:00:00")
    spark.createDataFrame([(4, dt.datetime(2024, 1, 5))], "Id int, UpdatedAt timestamp") \
        .write.jdbc(url, "Thing", mode="append", properties=props)
    mark = marks.get("Thing")
    later = read_jdbc(spark, url, "Thing", "UpdatedAt", mark, props)
    assert [r["Id"] for r in later.collect()] == [4]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        later.explain()
    plan = out.getvalue()
    assert "PushedFilters" in plan and "GreaterThan" in plan
    assert marks.advance("Thing", later.where(F.lit(False)), "UpdatedAt", "x") == mark
    split = read_jdbc(spark, url, "Thing", "UpdatedAt", None, props, partitions=3)
    assert split.rdd.getNumPartitions() == 3
    assert sorted(r["Id"] for r in split.collect()) == [1, 2, 3, 4]
    split_inc = read_jdbc(spark, url, "Thing", "UpdatedAt", dt.datetime(2024, 1, 1, 12), props, 3)
    assert sorted(r["Id"] for r in split_inc.collect()) == [2, 3, 4]


def test_zip_drops_are_streamed_once(spark, workdir):
    """A second start reads nothing, a new archive only itself; a broken member is quarantined."""
    import json
    import zipfile

    from quaylake.streaming.ingest import run_available_drops

    names = [c.split()[0] for c in schemas.SHIPMENT_JSON.split(", ")]

    def record(number, carrier):
        row = dict.fromkeys(names) | {"shipment_id": f"S{number}", "salesordernumber": f"O{number}",
                                      "carrier_name": carrier, "shipment_date": "2024-01-02"}
        return json.dumps(row)

    def drop(name, members):
        with zipfile.ZipFile(f"{workdir}/drops/{name}", "w") as archive:
            for member, body in members.items():
                archive.writestr(member, body)

    os.makedirs(f"{workdir}/drops")
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_", buckets=4)
    run = lambda: run_available_drops(spark, f"{workdir}/drops", lake, f"{workdir}/land",
                                      f"{workdir}/checkpoint", "2024-01-03 04:00:00")
    drop("a.zip", {"shipment_1.json": "\n".join(record(i, "first") for i in range(5)),
                   "shipment_2.json": record(7, "x") + '\n{"shipment_id": '})
    assert run() == 1
    assert run() == 0, "nothing is new"
    drop("b.zip", {"shipment_3.json": "\n".join(record(i, "second") for i in (3, 9))})
    assert run() == 1
    got = {r["salesordernumber"]: r["carrier_name"] for r in lake.table("silver.fact_shipments").collect()}
    assert got == {"O0": "first", "O1": "first", "O2": "first", "O3": "second", "O4": "first", "O9": "second"}
    lines = spark.read.text(f"{workdir}/land/error_data").select("value").collect()
    assert sorted(r[0] for r in lines) == sorted([record(7, "x"), '{"shipment_id": '])


def test_late_rows_behind_the_mark_are_read_once(spark, workdir):
    """A row committed late, with the mark's own time or before it, is found by the next read."""
    from quaylake.sources.incremental import above_mark, overlapped, unseen

    day = lambda d: dt.datetime(2024, 1, d)
    ddl = "Id int, UpdatedAt timestamp_ntz"
    marks = Bookmarks(spark, f"{workdir}/marks")
    loaded = spark.createDataFrame([(1, day(1)), (2, day(5))], ddl)
    marks.advance("Thing", loaded, "UpdatedAt", "2024-01-05 12:00:00")
    source = loaded.unionByName(spark.createDataFrame([(3, day(5)), (4, day(4)), (None, day(5))], ddl))
    start = overlapped(marks.get("Thing"), dt.timedelta(days=2))
    late = unseen(above_mark(source, "UpdatedAt", start), loaded, "Id", "UpdatedAt", start)
    assert {r["Id"] for r in late.collect()} == {3, 4, None}
    assert marks.advance("Thing", late.where("Id = 4"), "UpdatedAt", "2024-01-05 13:00:00") == day(5)
    again = unseen(above_mark(loaded, "UpdatedAt", start), loaded, "Id", "UpdatedAt", start)
    assert again.count() == 0
    assert marks.advance("Thing", again, "UpdatedAt", "2024-01-05 14:00:00") == day(5)


def test_mart_publishes_each_batch_once(spark):
    """Derby in this process: keyed merge, repeated and replayed batches, a refused batch, a snapshot."""
    import pytest

    from quaylake.sinks.mart import Mart

    mart = Mart(spark, f"jdbc:derby:memory:m{uuid.uuid4().hex};create=true",
                {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    ddl = "sku string, place int, amount decimal(10,2), seen timestamp"
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    frame = lambda *rows: spark.createDataFrame([(*r, at) for r in rows], ddl)
    dec = __import__("decimal").Decimal
    rows = lambda: sorted((r["sku"], r["place"], r["amount"], r["seen"])
                          for r in mart.table("stock").collect())
    keys = ["sku", "place"]
    first = frame(("a", 1, dec("1.00")), ("a", 2, dec("2.00")), ("b", 1, None))
    assert mart.upsert("stock", first, keys, "day 1")
    want = [("a", 1, dec("1.00"), at), ("a", 2, dec("2.00"), at), ("b", 1, None, at)]
    assert rows() == want
    assert not mart.upsert("stock", first, keys, "day 1"), "a repeated batch"
    assert mart.upsert("stock", frame(("a", 2, dec("5.50")), ("c", 9, dec("9.00"))), keys, "day 2")
    want = [want[0], ("a", 2, dec("5.50"), at), want[2], ("c", 9, dec("9.00"), at)]
    assert rows() == want
    assert not mart.upsert("stock", first, keys, "day 1"), "a replay takes nothing back"
    assert rows() == want
    twice = frame(("a", 1, dec("7.00")), ("a", 1, dec("8.00")), ("d", 4, dec("4.00")))
    with pytest.raises(Exception, match="(?i)merge"):
        mart.upsert("stock", twice, keys, "day 3")
    assert rows() == want, "a refused batch changes nothing"
    assert mart.upsert("stock", twice.where("amount <> 8"), keys, "day 3"), "mended, under its name"
    assert [r[:3] for r in rows()][0] == ("a", 1, dec("7.00")) and len(rows()) == 5
    assert mart.snapshot("stock", frame(("z", 0, dec("0.10"))), "day 4")
    assert rows() == [("z", 0, dec("0.10"), at)]
    assert not mart.snapshot("stock", first, "day 4")
    assert mart.snapshot("stock", first.limit(0), "day 5") and rows() == []
