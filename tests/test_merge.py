"""upsert / scd2 / keep_one on hand-written rows (MERGE rules D1-D3, T5)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from quaylake.operators.dedup import keep_one
from quaylake.operators.merge import scd2, upsert

T = "k int, a string, b int"


def df(spark, data, ddl=T):
    return spark.createDataFrame(data, ddl)


def test_upsert_updates_inserts_and_keeps(spark):
    target = df(spark, [(1, "x", 1), (2, "y", 2)])
    source = df(spark, [(2, "Y", 20), (3, "z", 3)])
    assert rows(upsert(target, source, ["k"])) == [(1, "x", 1), (2, "Y", 20), (3, "z", 3)]


def test_upsert_partial_update_and_exprs(spark):
    target = df(spark, [(1, "x", 1)])
    source = df(spark, [(1, "X", 10), (2, "n", 2)])
    out = upsert(target, source, ["k"], update_cols=["b"], insert_exprs={"a": F.lit("new")})
    assert rows(out) == [(1, "x", 10), (2, "new", 2)]


def test_upsert_missing_source_column_is_null_on_insert(spark):
    target = df(spark, [(1, "x", 1)])
    source = spark.createDataFrame([(2, 5)], "k int, b int")
    assert rows(upsert(target, source, ["k"])) == [(1, "x", 1), (2, None, 5)]


def test_upsert_null_keys_never_match(spark):
    target = df(spark, [(None, "old", 1)])
    source = df(spark, [(None, "new", 2)])
    plain = upsert(target, source, ["k"])
    assert len(rows(plain)) == 2, "MERGE inserts the NULL group again"
    safe = upsert(target, source, ["k"], null_safe_keys=True)
    assert rows(safe) == [(None, "new", 2)]


def test_upsert_duplicate_source_keys(spark):
    target = df(spark, [(1, "x", 1)])
    matching = df(spark, [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, matching, ["k"]).collect()
    new_dups = df(spark, [(5, "a", 1), (5, "b", 2)])
    assert len(rows(upsert(target, new_dups, ["k"]))) == 3, "unmatched duplicates are inserted"


def test_upsert_target_filter(spark):
    target = spark.createDataFrame([(1, "old", False), (1, "cur", True)], "k int, a string, c boolean")
    source = spark.createDataFrame([(1, "upd", True)], "k int, a string, c boolean")
    out = upsert(target, source, ["k"], target_filter=F.col("c"))
    assert rows(out) == [(1, "old", False), (1, "upd", True)]


SCD = ("id int, name string, city string, start_date timestamp, end_date timestamp, "
       "is_current boolean, created_at timestamp, updated_at timestamp")


def version(spark, data):
    return spark.createDataFrame(
        [(i, n, c, None, None, True, None, None) for i, n, c in data], SCD)


def test_scd2_three_versions(spark):
    empty = spark.createDataFrame([], SCD)
    v1 = scd2(empty, version(spark, [(1, "a", "X"), (2, "b", "Y")]), "id", ["name", "city"],
              "2024-01-01 00:00:00")
    v2 = scd2(v1, version(spark, [(1, "a", "Z"), (3, "c", "W")]), "id", ["name", "city"],
              "2024-02-01 00:00:00")
    v3 = scd2(v2, version(spark, [(1, "a2", "Z"), (2, "b", "Y")]), "id", ["name", "city"],
              "2024-03-01 00:00:00")
    out = v3.orderBy("id", "start_date").collect()
    one = [(r["name"], r["city"], r["is_current"]) for r in out if r["id"] == 1]
    assert one == [("a", "X", False), ("a", "Z", False), ("a2", "Z", True)]
    assert [r["is_current"] for r in out if r["id"] == 2] == [True], "unchanged stays one row"
    current = v3.where("is_current").groupBy("id").count().where("count > 1").count()
    assert current == 0
    closed = [r for r in out if r["id"] == 1 and not r["is_current"]]
    assert [str(r["end_date"]) for r in closed] == ["2024-02-01 00:00:00", "2024-03-01 00:00:00"]


def test_scd2_null_is_no_change_unless_null_safe(spark):
    empty = spark.createDataFrame([], SCD)
    v1 = scd2(empty, version(spark, [(1, "a", None)]), "id", ["name", "city"], "2024-01-01")
    v2 = scd2(v1, version(spark, [(1, "a", "X")]), "id", ["name", "city"], "2024-02-01")
    assert v2.count() == 1
    v2s = scd2(v1, version(spark, [(1, "a", "X")]), "id", ["name", "city"], "2024-02-01",
               null_safe=True)
    assert v2s.count() == 2


def test_keep_one_order_and_ties(spark):
    data = df(spark, [(1, "b", 5), (1, "a", 5), (1, "c", 1), (2, None, None), (2, "z", 3)])
    latest = keep_one(data, ["k"], ["b DESC"])
    assert rows(latest) == [(1, "a", 5), (2, "z", 3)], "ties broken by the other columns"
    earliest = keep_one(data, ["k"], ["b ASC"])
    assert rows(earliest) == [(1, "c", 1), (2, None, None)], "ASC puts NULL first"


def test_scd2_rejects_duplicate_source_keys(spark):
    empty = spark.createDataFrame([], SCD)
    dup = version(spark, [(1, "a", "X"), (1, "b", "Y")])
    with pytest.raises(PySparkException, match="several source rows"):
        scd2(empty, dup, "id", ["name", "city"], "2024-01-01").collect()


def test_scd2_null_keys_are_new_versions_either_way(spark):
    ddl = ("k int, v string, start_date timestamp, end_date timestamp, is_current boolean, "
           "created_at timestamp, updated_at timestamp")
    target = spark.createDataFrame([(1, "a", None, None, True, None, None),
                                    (None, "n", None, None, True, None, None)], ddl)
    source = spark.createDataFrame([(1, "b"), (None, "x"), (None, "y")], "k int, v string")
    runs = [sorted((str(r["k"]), r["v"], r["is_current"]) for r in scd2(
        target, source, "k", ["v"], "2024-01-01 00:00:00", check_duplicates=check).collect())
        for check in (True, False)]
    assert runs[0] == runs[1] == [("1", "a", False), ("1", "b", True), ("None", "n", True),
                                  ("None", "x", True), ("None", "y", True)]
