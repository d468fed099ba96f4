import pytest

from calltext.operators.incremental import of_todo_files, replace_by_key, todo
from calltext.operators.relational import (
    group_max_rows,
    group_min_rows,
    groups_larger_than,
    natural_join,
    not_in,
    suffix_join,
    with_group_size,
)
from pyspark.sql import functions as F
from tests.conftest import rows

PAIRS = "f string, p int"


def test_not_in_agrees_with_sql(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", None), ("b", 1), ("b", None), ("c", 1), ("d", None)], PAIRS)
    denied = spark.createDataFrame([("a", 1), ("b", None), ("e", 1)], PAIRS)
    df.createOrReplaceTempView("df_rows")
    denied.createOrReplaceTempView("denied_rows")
    expected = spark.sql(
        "SELECT * FROM df_rows WHERE (f, p) NOT IN (SELECT f, p FROM denied_rows)")
    assert rows(not_in(df, denied, ["f", "p"])) == rows(expected) == [
        ("a", 2), ("c", 1), ("d", None)]


def test_not_in_plan_has_no_nested_loop(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("f"), F.lit(1).alias("p"))
    plan = not_in(df, df, ["f", "p"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "LeftAnti" in plan


def test_not_in_refuses_null_lead_key(spark):
    df = spark.createDataFrame([("a", 1)], PAIRS)
    denied = spark.createDataFrame([(None, 1)], PAIRS)
    with pytest.raises(Exception, match="must not be NULL"):
        not_in(df, denied, ["f", "p"]).collect()


def test_natural_join_does_not_match_null(spark):
    a = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    b = spark.createDataFrame([("a", 3), (None, 4)], "k string, y int")
    assert rows(natural_join(a, b)) == [("a", 1, 3)]
    assert rows(natural_join(a, b, "right"), "k", "x", "y") == [(None, None, 4), ("a", 1, 3)]
    with pytest.raises(ValueError):
        natural_join(a, b.select("y"))


def test_suffix_join(spark):
    a = spark.createDataFrame([("k", 1, 2)], "k string, v int, x int")
    b = spark.createDataFrame([("k", 3, 4)], "k string, v int, y int")
    assert suffix_join(a, b, ["k"]).columns == ["k", "v_x", "x", "v_y", "y"]


def test_group_filters_keep_null_groups_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 3), ("a", 3), ("b", 1), (None, 1), (None, None)], "k string, v int")
    assert rows(groups_larger_than(df, ["k"])) == [
        (None, None), (None, 1), ("a", 1), ("a", 3), ("a", 3)]
    assert rows(with_group_size(df, ["k"], "n"), "k", "n") == [
        (None, 2), (None, 2), ("a", 3), ("a", 3), ("a", 3), ("b", 1)]
    assert rows(group_max_rows(df, ["k"], "v")) == [(None, 1), ("a", 3), ("a", 3), ("b", 1)]


def test_group_min_rows_does_not_filter_the_rows_again(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 2, False)],
                               "k string, v int, ok boolean")
    assert rows(group_min_rows(df, ["k"], "v", among=F.col("ok"))) == [
        ("a", 2, False), ("a", 2, True)]


def test_todo(spark):
    schema = "file_name string, last_update int"
    wanted = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), ("c", 1)], schema)
    done = spark.createDataFrame([("a", 1), ("b", None)], schema)
    assert rows(todo(wanted, None)) == [("a", 1), ("a", 2), ("b", None), ("c", 1)]
    assert rows(todo(wanted, done)) == [("a", 2), ("c", 1)]
    assert rows(todo(wanted, done, limit=1)) == [("a", 2)]
    assert rows(todo(wanted, done, spark.createDataFrame([("c", 1)], schema))) == [("a", 2)]
    # Work is by file: the done version of "a" comes along.
    assert rows(of_todo_files(wanted, todo(wanted, done))) == [
        ("a", 1), ("a", 1), ("a", 2), ("c", 1)]


def test_replace_by_key_is_idempotent_and_clears_processed_files(spark):
    schema = "file_name string, v int"
    old = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], schema)
    new = spark.createDataFrame([("a", 2), ("d", 2)], schema)
    once = replace_by_key(old, new, "file_name")
    assert rows(once) == [("a", 2), ("b", 1), ("c", 1), ("d", 2)]
    assert rows(replace_by_key(once, new, "file_name")) == rows(once)
    processed = spark.createDataFrame([("a",), ("b",), ("d",)], "file_name string")
    assert rows(replace_by_key(old, new, "file_name", processed)) == [
        ("a", 2), ("c", 1), ("d", 2)]
