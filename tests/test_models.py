"""Dedup-merge, exploded relations, dimensions, bridge."""

from __future__ import annotations

from pyspark.sql import functions as F

from postline.functions.columns import map_text
from postline.operators import bridge, dedup
from postline.plans import models


def _rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple(repr(x) for x in t))


def _flat_stg(stg):
    return stg.select(*[c for c in stg.columns if c not in ("job_skills_array", "job_type_skills")],
                      F.array_join("job_skills_array", "|").alias("s"), map_text("job_type_skills").alias("t"))


def test_one_shuffle_merge_equals_relational_shape(small_landing):
    a = _flat_stg(dedup.dedup_merge(small_landing, models.RUN_TS))
    b = _flat_stg(dedup.dedup_merge_joined(small_landing, models.RUN_TS))
    assert a.count() == b.count() > 0
    assert _rows(a) == _rows(b)


def test_keep_first_window_equals_min_by(small_landing):
    keyed = dedup.with_business_key(small_landing).select("business_key", "raw_job_id", "ingested_at")
    w = dedup.keep_first_window(keyed)
    m = dedup.keep_first(keyed, cols=["raw_job_id", "ingested_at"])
    assert _rows(w) == _rows(m)


def test_keep_first_puts_null_timestamps_last(spark):
    df = spark.createDataFrame(
        [("k", 1, None), ("k", 2, "2024-01-02 00:00:00"), ("k", 3, "2024-01-01 00:00:00"),
         ("j", 4, None), ("j", 5, None)],
        "business_key string, raw_job_id long, ingested_at string",
    ).withColumn("ingested_at", F.to_timestamp("ingested_at"))
    got = dict((r.business_key, r.raw_job_id) for r in dedup.keep_first(df).collect())
    assert got == {"k": 3, "j": 4}
    got_w = dict((r.business_key, r.raw_job_id) for r in dedup.keep_first_window(df).collect())
    assert got_w == got


def test_hot_key_holding_a_third_of_rows(small_landing):
    """A third of all rows share one business key: still one row, all skills merged."""
    hot = small_landing.withColumn(
        "company_name", F.when(F.col("id") % 3 == 0, F.lit("Hot Co")).otherwise(F.col("company_name")))
    for col in ["job_title", "job_location", "job_posted_date", "job_schedule_type", "job_via", "job_country",
                "salary_rate"]:
        hot = hot.withColumn(col, F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col(col)))
    for col in ["salary_year_avg", "salary_hour_avg", "job_work_from_home", "job_no_degree_mention",
                "job_health_insurance"]:
        hot = hot.withColumn(col, F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col(col)))
    a = _flat_stg(dedup.dedup_merge(hot, models.RUN_TS))
    b = _flat_stg(dedup.dedup_merge_joined(hot, models.RUN_TS))
    assert _rows(a) == _rows(b)
    hot_rows = a.where(F.col("company_name") == "Hot Co").collect()
    assert len(hot_rows) == 1
    expected = sorted({s.strip() for r in hot.where(F.col("id") % 3 == 0).select("job_skills").collect()
                       for s in (r.job_skills or []) if s.strip()})
    assert hot_rows[0].s == "|".join(expected)
    # the aggregate is split into a map-side partial and a final step around one exchange
    plan = dedup.dedup_merge(hot, models.RUN_TS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_rows_of_small_keys_are_not_expanded(small_landing, monkeypatch):
    """Only keys of many items are expanded; whatever the limit is, the staged rows are the same."""
    merge = lambda: dedup.dedup_merge(small_landing, models.RUN_TS)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan(merge())
    want = _rows(_flat_stg(dedup.dedup_merge_joined(small_landing, models.RUN_TS)))
    for limit in (0, 12):
        monkeypatch.setattr(dedup, "WHOLE_ITEMS", limit)
        assert "Generate" in plan(merge())
        assert _rows(_flat_stg(merge())) == want


def test_merge_of_odd_sets(spark, monkeypatch):
    """Blank and null items, no sets at all, a map without pairs, rows with equal places."""
    raw = spark.createDataFrame(
        [(1, "x", [" a", "b", "a ", "", None], {"k": ["v", " v"], " ": ["z"]}), (2, "X ", ["c"], None),
         (3, "y", None, {" ": ["q"]}), (4, "z", [], None), (4, "z", ["d"], {"m": ["n"], "k": ["o"]}), (5, None, None, None)],
        "id long, company_name string, job_skills array<string>, job_type_skills map<string,array<string>>")
    for c in dedup.POSTING_COLUMNS:
        if c not in raw.columns:
            kind = "decimal(12,2)" if c.startswith("salary_") and c != "salary_rate" else "string"
            raw = raw.withColumn(c, F.lit(None).cast(kind))
    raw = raw.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    want = {1: ("a|b|c", "k:v"), 3: ("", " :q"), 4: ("d", "k:o;m:n"), 5: ("", "")}
    for limit in (1000, 3, 0):
        monkeypatch.setattr(dedup, "WHOLE_ITEMS", limit)
        got = {r.raw_job_id: (r.s, r.t) for r in _flat_stg(dedup.dedup_merge(raw, models.RUN_TS)).collect()}
        assert got == want, limit


def test_bridge_row_local_equals_relational(small_models):
    m = small_models
    joined = bridge.job_skill_joined(m["stg_job_skills_exploded"], m["stg_job_type_skills_exploded"], m["skill"],
                                     m["skill_category"], m["job_posting"], models.RUN_TS)
    cols = ["job_id", "skill_id", "skill_cat_id", "ingested_at"]
    assert _rows(m["job_skill"], cols) == _rows(joined, cols)


def test_bridge_plan_has_no_shuffle(small_models):
    plan = bridge.job_skill(small_models["stg_raw_jobs"], models.RUN_TS)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_dimensions_unique_and_canonical(small_models):
    for name, col in [("company", "company_name"), ("country", "country_name"), ("skill", "skill_name"),
                      ("skill_category", "category_name")]:
        d = small_models[name]
        names = [r[0] for r in d.select(col).collect()]
        assert len(names) == len(set(names)) > 0
        assert all(n == n.strip().lower() and n for n in names)


def test_postings_without_company_leave_core(small_models):
    stg, posting = small_models["stg_raw_jobs"], small_models["job_posting"]
    blank = stg.where(F.nullif(F.trim("company_name"), F.lit("")).isNull()).count()
    assert blank > 0
    assert posting.count() == stg.count() - blank


def test_case_variants_make_duplicate_assignment_ids(small_models):
    # 'RED WIDGET' and 'red widget' survive dedup (case-sensitive) and collide after lowering
    flat = small_models["stg_job_skills_exploded"]
    dups = flat.groupBy("skill_assignment_id").count().where("count > 1").count()
    assert dups > 0


def test_nested_as_json_and_exists(small_models):
    from postline.operators.nested import nested_as_json
    from postline.sources.ledger import exists
    stg = small_models["stg_raw_jobs"]
    out = nested_as_json(stg.select("business_key", "job_skills_array", "job_type_skills")).first()
    assert out.job_skills_array.startswith("[") and out.job_type_skills.startswith("{")
    assert exists(stg) and not exists(stg.where("1 = 0"))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_posting_models_parse_no_skill(spark):
    from shared import SF_SMALL
    core = dedup.posting_core(models.landing_from_tables(spark, SF_SMALL), models.RUN_TS)
    for name, df in models.posting_models(core, models.RUN_TS).items():
        plan = _plan(df)
        assert "ArrowEvalPython" not in plan and "Generate explode(skill" not in plan and "from_json" not in plan, name


def test_posting_core_equals_staging(small_landing):
    core = dedup.posting_core(small_landing, models.RUN_TS)
    stg = dedup.dedup_merge(small_landing, models.RUN_TS).select(*core.columns)
    assert sorted(map(repr, core.collect())) == sorted(map(repr, stg.collect()))


def test_top_skills_from_staging_equals_the_joined_form(small_models):
    from postline.plans import star
    m = small_models
    joined = star.top_skills_by_title(m["job_posting"], m["job_skill"], m["skill"], m["job_title_category"])
    local = star.top_skills_from_staging(m["stg_raw_jobs"])
    assert sorted(map(repr, map(tuple, local.collect()))) == sorted(map(repr, map(tuple, joined.select(*local.columns).collect())))
    assert "Join" not in _plan(local)


def test_links_and_folds_of_one_large_posting(spark):
    """20,000 skills in one row: sets hash, categories are slices of sorted pairs."""
    import time
    n = 20_000
    big = spark.range(1).selectExpr(
        f"transform(sequence(1, {n}), i -> concat('s', i)) AS job_skills_array",
        f"map_from_entries(transform(sequence(0, 99), c -> struct(concat('c', c), "
        f"transform(sequence(1, {n // 100}), i -> concat('s', c * {n // 100} + i))))) AS job_type_skills")
    started = time.monotonic()
    assert big.select(F.size(bridge.job_links()).alias("n")).first()["n"] == 2 * n
    pairs = big.select(dedup.trimmed_type_pairs(F.col("job_type_skills")).alias("p"))
    folded = pairs.select(dedup.fold_pairs(F.col("p")).alias("m")).selectExpr("size(m) AS n", "size(m['c7']) AS k").first()
    assert (folded["n"], folded["k"]) == (100, n // 100)
    assert time.monotonic() - started < 60


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_skill_dimension_merges_the_landing_rows_once(spark, small_landing, small_models):
    """Both exploded relations read a stored copy; the merge per business key is no part of the plan."""
    got = models.skill_dimension(small_landing, models.RUN_TS)
    assert "collect_set" not in _plan(got)
    names = lambda df: _rows(df.select("skill_id", "skill_name"))
    assert names(got) == names(small_models["skill"])


def test_shared_staging_is_stored_in_columns(small_landing):
    """A consumer of the shared staged relation reads its columns alone."""
    staged = models.shared_models(small_landing, models.RUN_TS)["stg_raw_jobs"].select("business_key")
    assert "parquet" in _plan(staged) and "job_skills_array" not in _plan(staged)
