import random

import pytest
from pyspark.sql import functions as F

from tradewatch.operators.numbering import numbered


@pytest.mark.parametrize("tasks", [1, 7])
def test_numbers_within_groups_and_overall(spark, tasks):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, 1, 2, 3]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, number long").repartition(tasks)
    df = df.withColumnRenamed("number", "id")
    order = lambda x: (x["o"] is not None, x["o"] or 0, x["id"])
    got = numbered(df, ["o", "id"], ["g"]).collect()
    for g in ("a", "b", None, "hot"):
        own = sorted((x for x in got if x["g"] == g), key=order)
        assert [x["number"] for x in own] == list(range(len(own))) and own
    whole = sorted(numbered(df, ["o", "id"], name="at").collect(), key=order)
    assert [x["at"] for x in whole] == list(range(500))


def test_ranks_of_other_groups_in_the_same_order(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice(["x", None, "hot", "hot", "hot"])) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, g string").repartition(6)
    got = {x["id"]: x for x in numbered(df, [-F.col("id")], name="at", ranks={"rank": ["g"]}).collect()}
    for g in ("x", None, "hot"):
        own = sorted((k for k, v in rows if v == g), reverse=True)
        assert [got[k]["rank"] for k in own] == list(range(len(own)))
        assert {got[k]["rank_first"] for k in own} == {399 - own[0]}


def test_equal_rows_empty_tables_and_clashing_names(spark):
    same = spark.createDataFrame([(1, 2)] * 50, "__at long, `a.b` long").repartition(5)
    out = numbered(same, ["__at"])
    assert out.columns == ["__at", "a.b", "number"]
    assert sorted(x["number"] for x in out.collect()) == list(range(50))
    assert numbered(same.where("false"), ["__at"]).count() == 0


def test_no_window_without_partition(spark):
    df = spark.range(100)
    plan = numbered(df, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("[__group" in x for x in plan.splitlines() if "Window" in x)
