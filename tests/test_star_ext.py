"""Cube, validity intervals and moving measures on small frames, and their plans."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from postline.operators import quality
from postline.plans import star

POSTING = "company_id string, country_id string, platform_id string, posted_date string, salary_year_avg decimal(12,2)"


def _postings(spark, n=400, companies=5):
    rnd = random.Random(n)
    rows = []
    for _ in range(n):
        day = date(2024, 1, 1) + timedelta(days=rnd.randrange(90))
        rows.append((rnd.choice(["hot", *[f"c{k}" for k in range(companies)]]), rnd.choice(["de", "fr", None]), rnd.choice(["p", "q"]),
                     rnd.choice([f"{day} 10:00:00", "no date", None]), rnd.choice([None, "100.01", "99.98"])))
    return spark.createDataFrame(rows, POSTING.replace("decimal(12,2)", "string")).withColumn(
        "salary_year_avg", F.col("salary_year_avg").cast("decimal(12,2)"))


def test_cube_subtotals_equal_separate_groupings(spark):
    posting = _postings(spark)
    cube = star.posting_cube(posting)
    month = posting.withColumn("month", F.date_trunc("month", star.posted_ts()))
    keys = ["month", "company_id", "country_id", "platform_id"]
    for chosen in star.CUBE_SETS:
        bits = sum(8 >> i for i, k in enumerate(keys) if k not in chosen)
        got = sorted(map(repr, cube.where(F.col("grouping") == bits).select(*chosen, "job_count", "jobs_with_year_salary").collect()))
        want = month.groupBy(*chosen).agg(F.count("*").alias("job_count"), F.count("salary_year_avg").alias("jobs_with_year_salary"))
        assert got == sorted(map(repr, want.collect())), chosen
    plan = star.posting_cube(posting)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand [") == 1 and plan.count("Exchange ") == 1


def test_intervals_rebuild_the_days(spark):
    rnd = random.Random(4)
    rows = [(j, date(2024, 1, 1) + timedelta(days=d), rnd.choice(["a", "b", None]), rnd.choice([1, None]), 1)
            for j in ("x", "y", "z") for d in sorted(rnd.sample(range(60), 30))]
    daily = spark.createDataFrame(rows, "job_id string, ingestion_date date, company_id string, flags int, records_seen long")
    spans = star.validity_intervals(daily).collect()
    for job in ("x", "y", "z"):
        own = sorted((s for s in spans if s.job_id == job), key=lambda s: s.span_no)
        assert own[-1].valid_to is None and all(a.valid_to + timedelta(days=1) == b.valid_from for a, b in zip(own, own[1:]))
        assert all((a.company_id, a.flags) != (b.company_id, b.flags) for a, b in zip(own, own[1:]))
        for _, day, company, flags, _ in (r for r in rows if r[0] == job):
            hit = [s for s in own if s.valid_from <= day and (s.valid_to is None or day <= s.valid_to)]
            assert len(hit) == 1 and (hit[0].company_id, hit[0].flags) == (company, flags)
        assert sum(s.days_seen for s in own) == 30


@pytest.mark.parametrize("days", [1, 28])
def test_moving_volume_equals_brute_force(spark, days):
    posting = _postings(spark)
    rows = [(r.company_id, r.d, r.salary_year_avg) for r in posting.withColumn("d", F.to_date(star.posted_ts())).collect() if r.d]
    got = star.moving_volume(posting, days).collect()
    assert {(r.company_id, r.posting_date) for r in got} == {(c, d) for c, d, _ in rows}
    for r in got:
        near = [s for c, d, s in rows if c == r.company_id and timedelta(0) <= r.posting_date - d < timedelta(days=days)]
        paid = [int(s * 100) for s in near if s is not None]
        mean = (2 * sum(paid) + len(paid)) // (2 * len(paid)) / 100 if paid else None
        assert (r.jobs_moving, r.paid_moving, r.avg_salary_moving) == (len(near), len(paid), mean)


def test_days_are_aggregated_before_the_window(spark):
    plan = star.moving_volume(_postings(spark, 50))._jdf.queryExecution().executedPlan().toString()
    window, first_aggregate = plan.index("Window"), plan.index("HashAggregate")
    assert window < first_aggregate and plan.count("Exchange") == 2


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_filtered_orphans_equal_the_plain_ones(spark, bits):
    child = spark.range(500).selectExpr("if(id % 9 = 0, null, id % 100) AS k")
    parent = spark.range(100).where("id % 3 <> 0").selectExpr("if(id = 50, null, id) AS p")
    plain = sorted(map(tuple, quality.relationships(child, "k", parent, "p").collect()))
    assert sorted(map(tuple, quality.relationships_filtered(child, "k", parent, "p", bits=bits).collect())) == plain
    none = parent.where("p < 0")
    assert quality.relationships_filtered(child, "k", none, "p").count() == 100
