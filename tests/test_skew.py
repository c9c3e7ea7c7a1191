import random

import pytest
from pyspark.sql import functions as F

from tradewatch.operators.skew import first_per_key, heavy_split_join, running_sums, salted_join


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def skewed(spark):
    rng = random.Random(1)
    keys = ["hot"] * 600 + [f"k{rng.randrange(40)}" for _ in range(400)] + [None] * 5 + ["absent"] * 3
    return spark.createDataFrame(list(enumerate(keys)), "n long, k string")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_equals_join(spark, no_broadcast, how):
    left = skewed(spark)
    right = left.filter("k != 'absent' and k != 'k3'").groupBy("k").agg(F.count("*").alias("w"))
    assert rows_of(salted_join(left, right, ["k"], how, salts=5)) == rows_of(left.join(right, ["k"], how).select(
        *salted_join(left, right, ["k"], how, salts=5).columns))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("heavy", [1, 2, 3, 1000])
def test_heavy_split_join_equals_join(spark, no_broadcast, how, heavy):
    left = skewed(spark)
    right = left.filter("k != 'absent' and k != 'k3'").groupBy("k").agg(F.count("*").alias("w"))
    # Two rows for one key: both must be met whether the key is heavy or not.
    right = right.unionByName(right.filter("k in ('hot', 'k1')").select("k", "w"))
    got = heavy_split_join(left, right, ["k"], "w", how, heavy=heavy)
    assert rows_of(got) == rows_of(left.join(right, ["k"], how).select("n", "k", "w"))


def test_copies_of_a_dimension_are_not_broadcast(spark):
    left = skewed(spark)
    right = left.groupBy("k").agg(F.count("*").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        large = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
        plan = salted_join(left, large, ["k"], salts=16)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        small = salted_join(left, spark.range(5).select(F.concat(F.lit("k"), "id").alias("k")), ["k"])
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "__salt" not in plan
        assert rows_of(salted_join(left, right, ["k"])) == rows_of(left.join(right, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_rows_spread_over_tasks(spark, no_broadcast):
    left = spark.range(4000).select(F.col("id").alias("n"), F.lit("hot").alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("w"))
    joined = heavy_split_join(left, right, ["k"], "w", "left")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    assert rows_of(first_per_key(df, ["k"], [F.col("o")])) == [("a", 1, "y"), ("b", 5, None)]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_running_sums_equal_plain_sums(spark, block):
    rng = random.Random(2)
    data = [(k, o, rng.randrange(100)) for k in "ab" for o in rng.sample(range(50), 20)]
    expected = sorted((k, o, v, sum(w for j, p, w in data if j == k and p <= o)) for k, o, v in data)
    got = running_sums(spark.createDataFrame(data, "k string, o long, v long"), ["k"], "o", ["v"], block)
    assert rows_of(got) == sorted(expected, key=repr)
