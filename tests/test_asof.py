from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from postline.operators.asof import with_open_interval

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("seconds", [600, 86_400])
def test_equals_brute_force(spark, seconds):
    rnd = random.Random(seconds)
    at = lambda: T0 + timedelta(seconds=rnd.randrange(100_000))
    runs = []
    for i in range(60):
        start = at()
        end = rnd.choice([None, start + timedelta(seconds=rnd.randrange(1, 9000)), start - timedelta(seconds=5)] if i % 6 == 0
                         else [start + timedelta(seconds=rnd.randrange(1, 9000))])
        runs.append((f"r{i}", rnd.choice([start, start, start, None]), end))
    runs += [("twin", runs[1][1], runs[1][2]), ("twin", runs[1][1], runs[1][2])]
    rows = [(i, at()) for i in range(800)] + [(1000 + i, T0 + timedelta(seconds=50_000)) for i in range(300)] + [(2000, None), (2001, T0 - timedelta(days=9))]
    got = with_open_interval(spark.createDataFrame(rows, "i long, t timestamp"), "t",
                             spark.createDataFrame(runs, "run string, a timestamp, b timestamp"), "a", "b", "run", seconds=seconds).collect()
    assert len(got) == len(rows)
    for r in got:
        fit = [(a, n) for n, a, b in runs if r.t is not None and a is not None and a <= r.t and (b is None or (b > a and r.t < b))]
        assert r.open_name == (max(fit)[1] if fit else None), r


def test_plan_has_no_cross_join_of_rows(spark):
    rows = spark.sql("SELECT id, timestamp '2024-01-01' + make_dt_interval(0, 0, 0, id) AS t FROM range(10)")
    runs = rows.selectExpr("cast(id AS string) AS run", "t AS a", "t + interval 2 seconds AS b")
    plan = with_open_interval(rows, "t", runs, "a", "b", "run")._jdf.queryExecution().executedPlan().toString()
    top = plan[:plan.index("Aggregate")]
    assert "NestedLoop" not in top and "Cartesian" not in plan and "Python" not in plan
    assert with_open_interval(rows, "t", runs.limit(0), "a", "b", "run").where("open_name is not null").count() == 0
