"""Sketches of segments merged against exact figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from postline.plans.profile import estimates, measured, merged, segment_sketches


def test_merged_sketches_hold(spark):
    rows = spark.range(40_000).selectExpr("id % 7 AS seg", "cast(xxhash64(id) % 9000 AS string) AS word",
                                          "cast((id * id) % 100003 AS double) / 4 AS amount", "cast(null AS decimal(8,2)) AS nothing")
    got = {r.column: r for r in measured(rows, "seg", ["word", "amount", "nothing"]).collect()}
    assert got["word"].exact_distinct == rows.select("word").distinct().count() and got["word"].distinct_error < 0.04
    assert got["amount"].rank_error < 0.02 and got["word"].rank_error is None
    assert (got["nothing"].n_nulls, got["nothing"].exact_distinct, got["nothing"].rank_error) == (40_000, 0, None)


def test_parts_in_any_grouping_give_the_same_counts(spark):
    rows = spark.range(5000).selectExpr("id % 50 AS seg", "id % 2 AS half", "id % 321 AS v").withColumn("seg2", F.lit(1))
    many, one = (estimates(merged(segment_sketches(rows, s, ["v"]))).first() for s in ("seg", "seg2"))
    assert many.distinct_values == one.distinct_values and many.n_rows == one.n_rows == 5000
    assert abs(many.q50 - 160) <= 8 and abs(one.q50 - 160) <= 8


def test_plan_has_one_shuffle_and_no_python(spark):
    rows = spark.range(100).selectExpr("id % 3 AS seg", "id AS v", "cast(id AS string) AS w")
    plan = segment_sketches(rows, "seg", ["v", "w"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
