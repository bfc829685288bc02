"""Upsert and insert-if-absent semantics."""

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from weblake.operators.upsert import insert_if_absent, upsert

SCHEMA = "k bigint, v string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0] is None, t))


def test_matched_updated_unmatched_kept_and_inserted(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA)
    assert _rows(upsert(t, s, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


def test_null_key_inserted_every_time(spark):
    t = spark.createDataFrame([(None, "old")], SCHEMA)
    s = spark.createDataFrame([(None, "new")], SCHEMA)
    assert _rows(upsert(t, s, ["k"])) == [(None, "new"), (None, "old")]


def test_multi_match_raises(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA)
    with pytest.raises((PySparkException, Py4JJavaError)) as exc:
        upsert(t, s, ["k"]).collect()
    assert "more than one source row" in str(exc.value)


def test_duplicate_source_keys_without_target_are_all_inserted(spark):
    t = spark.createDataFrame([], SCHEMA)
    s = spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA)
    assert _rows(upsert(t, s, ["k"])) == [(1, "x"), (1, "y")]


def test_duplicate_target_rows_all_updated(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    s = spark.createDataFrame([(1, "z")], SCHEMA)
    assert _rows(upsert(t, s, ["k"])) == [(1, "z"), (1, "z")]


def test_composite_key_and_idempotence(spark):
    schema = "h string, t bigint, p bigint, n string"
    t = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y")], schema)
    s = spark.createDataFrame([("a", 1, 2, "Y"), ("b", 1, 1, "z")], schema)
    once = upsert(t, s, ["h", "t", "p"])
    twice = upsert(once, s, ["h", "t", "p"])
    assert _rows(once) == _rows(twice) == [("a", 1, 1, "x"), ("a", 1, 2, "Y"), ("b", 1, 1, "z")]


def test_source_columns_aligned_by_name(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([("b", 1)], "v string, k int")
    assert _rows(upsert(t, s, ["k"])) == [(1, "b")]


def test_insert_if_absent_keeps_existing(spark):
    schema = "CompanyId bigint, ProductId bigint, Price double"
    t = spark.createDataFrame([(1, 1, 10.0)], schema)
    b = spark.createDataFrame([(1, 1, 99.0), (1, 2, 5.0)], schema)
    assert _rows(insert_if_absent(t, b, ["CompanyId", "ProductId"])) == [(1, 1, 10.0), (1, 2, 5.0)]


def test_insert_if_absent_batch_duplicate_raises(spark):
    schema = "CompanyId bigint, ProductId bigint, Price double"
    t = spark.createDataFrame([], schema)
    b = spark.createDataFrame([(1, 2, 1.0), (1, 2, 2.0)], schema)
    with pytest.raises((PySparkException, Py4JJavaError)):
        insert_if_absent(t, b, ["CompanyId", "ProductId"]).collect()


def test_condition_keys_are_expressions_and_the_rest_stays_in_the_join(spark):
    from weblake.operators.upsert import merge_condition
    t = spark.createDataFrame([(1, "Ann"), (2, "BOB"), (3, "eve")], SCHEMA)
    s = spark.createDataFrame([(10, "ann"), (20, "bob"), (30, "zoe"), (40, None)], SCHEMA)
    on = "lower(target.v) = source.v and source.k - target.k < 15 and 1 = 1"
    cond = merge_condition(t, s, on)
    assert len(cond.target_keys) == 1 and cond.rest is not None
    df = upsert(t, s, on)
    assert _rows(df) == [(2, "BOB"), (3, "eve"), (10, "ann"), (20, "bob"), (30, "zoe"), (40, None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    for bad in ("source.k > target.k", "target.k = target.k", "target.k = 1", []):
        with pytest.raises(ValueError):
            upsert(t, s, bad)


def test_condition_between_columns_of_other_names_and_types(spark):
    t = spark.createDataFrame([(1, "7"), (2, "8")], SCHEMA)
    s = spark.createDataFrame([(7, "one"), (9, "two")], SCHEMA)
    assert _rows(upsert(t, s, "target.v = source.k")) == [(2, "8"), (7, "one"), (9, "two")]


def test_exchanges_of_a_conditional_merge(spark):
    """The source's exchange is used twice, the target's second one holds keys and row ids only."""
    from pyspark.sql import functions as F
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.range(1000).select(F.col("id").alias("k"), F.lit("b").alias("v"), F.lit("wide").alias("w"))
        s = spark.range(500, 1500).select(F.col("id").alias("k"), F.lit("c").alias("v"), F.lit("wide").alias("w"))
        s = s.unionByName(s.filter("k < 700").withColumn("v", F.lit("a")))   # 200 keys come twice, one row of each matches
        df = upsert(t, s, "target.k = source.k and source.v > target.v")
        assert len(df.collect()) == 1700
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("ReusedExchange") == 1 and plan.count("- Exchange hashpartitioning") == 3
        assert plan.count("(v#") >= 1 and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
