"""Lakehouse writes: daily reload, empty reload, staged replace, rebuild, merge."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quaylake.sinks.writers import Lakehouse

REPORT = "k int, run_date date"


def test_reload_day_is_idempotent_and_clears(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.create_table("gold.rep", REPORT, ["run_date"])
    day1 = spark.createDataFrame([(1,), (2,)], "k int")
    day2 = spark.createDataFrame([(3,)], "k int")
    lake.reload_day("gold.rep", day1, "2024-01-01")
    lake.reload_day("gold.rep", day2, "2024-01-02")
    lake.reload_day("gold.rep", day2, "2024-01-02")
    assert lake.table("gold.rep").count() == 3
    lake.reload_day("gold.rep", day2.where("k < 0"), "2024-01-02")
    assert sorted(r["k"] for r in lake.table("gold.rep").collect()) == [1, 2]


def test_merge_into_partitioned_table_touches_only_source_days(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.create_table("silver.f", "k int, v string, d date", ["d"])
    first = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], "k int, v string, d string")
    lake.merge("silver.f", first.withColumn("d", F.col("d").cast("date")), ["d", "k"])
    second = spark.createDataFrame([(2, "B", "2024-01-02"), (3, "c", "2024-01-03")], "k int, v string, d string")
    lake.merge("silver.f", second.withColumn("d", F.col("d").cast("date")), ["d", "k"])
    got = sorted((r["k"], r["v"]) for r in lake.table("silver.f").collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]


def test_replace_and_rebuild(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.create_table("silver.t", "k int, v string", [])
    lake.replace("silver.t", spark.createDataFrame([(1, "a")], "k int, v string"))
    # Replace from a plan that reads the table itself (staged, so allowed).
    lake.replace("silver.t", lake.table("silver.t").withColumn("v", F.upper("v")))
    assert rows(lake.table("silver.t")) == [(1, "A")]
    lake.rebuild("gold.r", spark.createDataFrame([(1, 2.0)], "x int, y double"))
    lake.rebuild("gold.r", spark.createDataFrame([(5, 6.0)], "x int, y double"))
    assert rows(lake.table("gold.r")) == [(5, 6.0)]
    assert lake.list_tables("gold") == ["gold.r"]


def test_merge_keeps_rows_of_the_null_partition(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.create_table("silver.n", "k int, v string, p string", ["p"])
    lake.replace("silver.n", spark.createDataFrame([(1, "old", None), (2, "old", "a")], "k int, v string, p string"))
    source = spark.createDataFrame([(1, "new", None), (2, "new", "a")], "k int, v string, p string")
    lake.merge("silver.n", source, ["p", "k"])
    assert sorted((r["k"], r["v"], r["p"]) for r in lake.table("silver.n").collect() if r["p"]) == [(2, "new", "a")]
    assert sorted(r["v"] for r in lake.table("silver.n").where("p is null").collect()) == ["new", "old"]
    lake.merge("silver.n", source, ["p", "k"], null_safe_keys=True, check_duplicates=False)
    assert {r["v"] for r in lake.table("silver.n").where("p is null").collect()} == {"new"}


def test_a_failed_replace_leaves_the_old_contents(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.rebuild("gold.r", spark.createDataFrame([(1, "a")], "k int, v string"))
    bad = lake.table("gold.r").withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    for write in (lake.replace, lake.rebuild):
        with pytest.raises(Exception, match="broken"):
            write("gold.r", bad)
        assert rows(lake.table("gold.r")) == [(1, "a")]
    lake.replace("gold.r", lake.table("gold.r").withColumn("v", F.lit("b")))
    assert rows(lake.table("gold.r")) == [(1, "b")]
    assert lake.vacuum("gold.r") == 0, "the folder before is young"
    assert lake.vacuum("gold.r", keep_seconds=0) == 1
    assert rows(lake.table("gold.r")) == [(1, "b")]
    assert len(os.listdir(f"{workdir}/lake/gold/r/_versions")) == 1


def test_cleared_day_leaves_no_files(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.create_table("gold.rep", REPORT, ["run_date"])
    day = spark.createDataFrame([(3,)], "k int")
    lake.reload_day("gold.rep", day, "2024-01-02")
    lake.reload_day("gold.rep", day.where("k < 0"), "2024-01-02")
    assert lake.table("gold.rep").count() == 0
    lake.vacuum("gold.rep", keep_seconds=0)
    left = [n for _, _, names in os.walk(f"{workdir}/lake") for n in names if n.endswith(".parquet")]
    assert left == []


def parquet_files(folder):
    return {os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def test_a_job_killed_before_the_swap_leaves_the_old_day(spark, workdir, monkeypatch):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_")
    lake.create_table("gold.rep", REPORT, ["run_date"])
    lake.reload_day("gold.rep", spark.createDataFrame([(1,), (2,)], "k int"), "2024-01-02")
    planned = lake.table("gold.rep").inputFiles()

    class Killed(Exception):
        pass

    def stop(self, text, *args, **kw):
        if text.startswith("ALTER TABLE"):
            raise Killed
        return run(self, text, *args, **kw)

    run = type(spark).sql
    new = spark.createDataFrame([(7,)], "k int")
    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", stop)
        with pytest.raises(Killed):
            lake.reload_day("gold.rep", new, "2024-01-02")
    assert sorted(r["k"] for r in lake.table("gold.rep").collect()) == [1, 2]
    lake.reload_day("gold.rep", new, "2024-01-02")
    assert [r["k"] for r in lake.table("gold.rep").collect()] == [7]
    assert sorted(r["k"] for r in spark.read.parquet(*planned).collect()) == [1, 2], "files of readers that planned before"


def test_merge_of_one_key_scans_and_rewrites_one_bucket(spark, workdir, monkeypatch):
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_", buckets=64)
    lake.create_table("silver.f", "k int, v string", bucket_by=["k"])
    ddl = "k long, v string"       # the key is hashed in the table's type
    lake.merge("silver.f", spark.createDataFrame([(i, f"a{i}") for i in range(500)], ddl), ["k"])
    assert lake.table("silver.f").columns == ["k", "v"] and lake.table("silver.f").count() == 500
    before = set(lake.table("silver.f").inputFiles())
    plans, swap = [], Lakehouse._swap

    def spied(self, name, made, values):
        plans.append((made.inputFiles(), values))
        return swap(self, name, made, values)

    monkeypatch.setattr(Lakehouse, "_swap", spied)
    lake.merge("silver.f", spark.createDataFrame([(42, "new")], ddl), ["k"])
    (scanned, values), = plans
    scanned = [f for f in scanned if "/_versions/" in f]
    assert len(values) == 1 and len(scanned) == 1 and f"/_bucket={values[0][0]}/" in scanned[0], "one bucket of 64"
    after = set(lake.table("silver.f").inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1, "one bucket's file is replaced"
    got = {r["k"]: r["v"] for r in lake.table("silver.f").collect()}
    assert got == {**{i: f"a{i}" for i in range(500)}, 42: "new"}
    # A NULL key matches nothing and is inserted; an empty source changes nothing.
    lake.merge("silver.f", spark.createDataFrame([(None, "x")], ddl), ["k"])
    lake.merge("silver.f", spark.createDataFrame([(None, "y")], ddl), ["k"])
    lake.merge("silver.f", spark.createDataFrame([], ddl), ["k"])
    assert sorted(r["v"] for r in lake.table("silver.f").where("k is null").collect()) == ["x", "y"]
    lake.append("silver.f", spark.createDataFrame([(1000, "end")], ddl))
    lake.merge("silver.f", spark.createDataFrame([(1000, "END")], ddl), ["k"])
    assert lake.table("silver.f").where("k = 1000").collect() == [(1000, "END")]


DIM = "k int, v string, start_date timestamp, end_date timestamp, is_current boolean, created_at timestamp, updated_at timestamp"


def test_closed_versions_are_not_written_again(spark, workdir):
    """Loads into a versioned table give what the plain type-2 operator gives, and the files of
    versions closed before keep their names."""
    lake = Lakehouse(spark, f"{workdir}/lake", prefix=f"t{uuid.uuid4().hex[:8]}_", buckets=8)
    lake.create_table("silver.d", DIM, bucket_by=["k"], versioned=True)
    lake.create_table("silver.plain", DIM, [])
    loads = [[(i, "a") for i in range(40)], [(i, "b") for i in range(0, 40, 4)] + [(90, "n")],
             [(4, "c"), (5, "a"), (None, "z")], [(4, "c")], []]
    closed = set()
    for day, load in enumerate(loads, 1):
        source = spark.createDataFrame(load, "k int, v string")
        for name in ("silver.d", "silver.plain"):
            lake.merge_scd2(name, source, "k", ["v"], f"2024-01-0{day} 00:00:00")
        assert rows(lake.table("silver.d").select("k", "v", "start_date", "end_date", "is_current")) == rows(
            lake.table("silver.plain").select("k", "v", "start_date", "end_date", "is_current"))
        now = set(lake.table("silver.d").where("not is_current").inputFiles())
        assert closed <= now
        closed = now
    assert lake.table("silver.d").columns == [c.split()[0] for c in DIM.split(", ")]
    lake.vacuum("silver.d", keep_seconds=0)
    assert rows(lake.table("silver.d")) == rows(lake.table("silver.plain"))
    # A load repeated with its own time changes nothing more.
    lake.merge_scd2("silver.d", spark.createDataFrame(loads[2][:2], "k int, v string"), "k", ["v"], "2024-01-03 00:00:00")
    assert rows(lake.table("silver.d")) == rows(lake.table("silver.plain"))
