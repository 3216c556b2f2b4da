from pyspark.sql import functions as F

from postline.operators.bloom import KeyFilter


def test_every_partner_passes_and_most_others_do_not(spark):
    keys = spark.range(0, 3000, 3).selectExpr("id AS k", "cast(id AS string) AS s")
    rows = spark.range(3000).selectExpr("id AS a", "cast(id AS string) AS b", "'x' AS k")
    own = KeyFilter(keys, [F.col("k"), F.col("s")])
    may = {r.a for r in own.may_meet(rows, [F.col("a"), F.col("b")]).collect()}
    none = {r.a for r in own.meets_none(rows, [F.col("a"), F.col("b")]).collect()}
    assert set(range(0, 3000, 3)) <= may and len(may) < 1010 and may | none == set(range(3000)) and not may & none


def test_a_full_filter_nulls_and_no_keys(spark):
    keys, rows = spark.range(5000).toDF("k"), spark.sql("SELECT explode(array(1L, 9999L, null)) AS a")
    full = KeyFilter(keys, [F.col("k")], bits=64)
    assert {r.a for r in full.may_meet(rows, [F.col("a")]).collect()} == {1, 9999}
    assert {r.a for r in full.meets_none(rows, [F.col("a")]).collect()} == {None}
    empty = KeyFilter(keys.where("k < 0"), [F.col("k")])
    assert empty.may_meet(rows, [F.col("a")]).count() == 0 and empty.meets_none(rows, [F.col("a")]).count() == 3


def test_plan_is_a_bounded_broadcast_without_python(spark):
    own = KeyFilter(spark.range(10).toDF("k"), [F.col("k")])
    plan = own.may_meet(spark.range(100).toDF("a"), [F.col("a")])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "Python" not in plan
