"""Property tests: idempotence and key uniqueness of the merge operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from quaylake.functions import quality
from quaylake.operators.dedup import keep_one
from quaylake.operators.merge import scd2, upsert

KEYS = st.one_of(st.none(), st.integers(0, 6))
ROWS = st.lists(st.tuples(KEYS, st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=12)
FAST = settings(max_examples=15, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


def unique(data):
    seen, out = set(), []
    for r in data:
        if r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


@FAST
@given(ROWS, ROWS)
def test_upsert_twice_equals_once(spark, target, source):
    ddl = "k int, a string, b int"
    t = spark.createDataFrame(unique(target), ddl)
    s = spark.createDataFrame(unique(source), ddl)
    once = upsert(t, s, ["k"], null_safe_keys=True)
    twice = upsert(once, s, ["k"], null_safe_keys=True)
    assert rows(once) == rows(twice)


@FAST
@given(ROWS)
def test_keep_one_gives_one_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, a string, b int")
    out = keep_one(df, ["k"], ["b DESC"])
    assert out.count() == df.select("k").distinct().count()


@FAST
@given(ROWS, ROWS)
def test_scd2_at_most_one_current_version(spark, first, second):
    ddl = ("k int, a string, b int, start_date timestamp, end_date timestamp, "
           "is_current boolean, created_at timestamp, updated_at timestamp")

    def dim(data):
        return spark.createDataFrame(
            [(k, a, b, None, None, True, None, None) for k, a, b in unique(data) if k is not None],
            ddl)

    v1 = scd2(spark.createDataFrame([], ddl), dim(first), "k", ["a", "b"], "2024-01-01")
    v2 = scd2(v1, dim(second), "k", ["a", "b"], "2024-02-01")
    assert v2.where("is_current").groupBy("k").count().where("count > 1").count() == 0
    keys = {r[0] for r in unique(first) + unique(second) if r[0] is not None}
    assert {r["k"] for r in v2.where("is_current").collect()} == keys


@FAST
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-2, 5)),
                          st.one_of(st.none(), st.floats(-1, 5)),
                          st.one_of(st.none(), st.integers(0, 3))), max_size=10))
def test_rules_split_is_a_partition(spark, data):
    df = spark.createDataFrame(
        [(q, t, 1.0, c, 1, "s", "w", None if c is None else "2024-01-02", "2024-01-03")
         for q, t, c in data],
        "quantity int, taxamount double, unitprice double, customer_id int, product_id int, "
        "supplier_id string, warehouse_id string, createddate string, processeddate string")
    flagged = quality.flag(df)
    valid = flagged.where("error_flag = 0").count()
    bad = flagged.where("error_flag = 1").count()
    assert valid + bad == df.count()
