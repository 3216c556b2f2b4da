"""The posting entity and the posting–skill bridge.

``job_skill`` is built inside each staged row, without joins or a shuffle:

* skill ids and category ids are ``md5`` of names that are already canonical,
  and every such name is by construction a row of the skill / category
  dimension, so the dimension lookups (J3–J5) give exactly ``md5(name)``;
* a posting is valid (J6) exactly when its staged row has a company, which is
  a filter on that row;
* all bridge rows of one job come from one staged row (business keys are
  unique there), so ``distinct`` (A7) is ``array_distinct`` inside the row.

``job_skill_joined`` keeps the relational shape (UNION ALL of two lookups,
semi join to the postings, DISTINCT) and is used to check the shortcut.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.functions.columns import canon, hash_key
from postline.operators.nested import flat_skill_names, typed_skill_pairs


def job_posting(stg: DataFrame, run_ts: datetime | None) -> DataFrame:
    """One row per staged posting with a company; FKs hash names.

    Extra columns of ``stg`` starting with ``_`` are carried along.
    """
    extra = [c for c in stg.columns if c.startswith("_")]
    return stg.where(F.nullif(F.trim("company_name"), F.lit("")).isNotNull()).select(
        hash_key("business_key").alias("job_id"),
        "business_key",
        "raw_job_id",
        "job_title_short",
        F.col("job_title").alias("job_title_full"),
        "job_location",
        "search_location",
        F.col("job_posted_date").alias("posted_date"),
        F.col("job_work_from_home").alias("work_from_home"),
        F.col("job_no_degree_mention").alias("no_degree_mention"),
        F.col("job_health_insurance").alias("health_insurance"),
        "salary_year_avg",
        "salary_hour_avg",
        hash_key(canon("company_name")).alias("company_id"),
        hash_key(canon("job_title_short")).alias("title_cat_id"),
        hash_key(canon("job_schedule_type")).alias("schedule_type_id"),
        hash_key(canon("job_via")).alias("platform_id"),
        hash_key(canon("job_country")).alias("country_id"),
        hash_key(canon("salary_rate")).alias("rate_type_id"),
        "ingested_at",
        F.lit(run_ts).alias("created_at"),
        *extra,
    )


def job_links():
    """The distinct (skill_id, skill_cat_id) links of a staged row (M13 inside one row).

    A link is one string while duplicates are dropped: sets of strings hash, sets
    of structs are compared pair by pair.
    """
    flat = F.transform(flat_skill_names(F.coalesce(F.col("job_skills_array"), F.array().cast("array<string>"))),
                       lambda s: F.md5(s))
    typed = F.transform(
        F.coalesce(typed_skill_pairs(F.col("job_type_skills")),
                   F.array().cast("array<struct<skill_category:string,skill_name:string>>")),
        lambda p: F.concat(F.md5(p["skill_name"]), F.md5(p["skill_category"])))
    return F.transform(F.array_distinct(F.concat(flat, typed)), lambda x: F.struct(
        F.substring(x, 1, 32).alias("skill_id"), F.nullif(F.substring(x, 33, 32), F.lit("")).alias("skill_cat_id")))


def job_skill(stg: DataFrame, run_ts: datetime) -> DataFrame:
    """(job_id, skill_id, skill_cat_id) per valid posting, row-local."""
    links = job_links()
    return (
        stg.where(F.nullif(F.trim("company_name"), F.lit("")).isNotNull())
        .select(hash_key("business_key").alias("job_id"), "ingested_at", F.explode(links).alias("l"))
        .select("job_id", "l.skill_id", "l.skill_cat_id", "ingested_at", F.lit(run_ts).alias("created_at"))
    )


def job_skill_joined(flat: DataFrame, grouped: DataFrame, skill: DataFrame, category: DataFrame,
                     posting: DataFrame, run_ts: datetime) -> DataFrame:
    """M13 in relational shape (U2 + J3–J6 + A7)."""
    sk = skill.select(F.col("skill_name").alias("_sk_name"))
    cat = category.select(F.col("category_name").alias("_cat_name"))
    from_flat = flat.join(sk, flat.skill_name == sk._sk_name, "left").select(
        hash_key("business_key").alias("job_id"), hash_key("_sk_name").alias("skill_id"),
        F.lit(None).cast("string").alias("skill_cat_id"), "ingested_at")
    from_grouped = (
        grouped.join(sk, grouped.skill_name == sk._sk_name, "left")
        .join(cat, grouped.skill_category == cat._cat_name, "left")
        .select(hash_key("business_key").alias("job_id"), hash_key("_sk_name").alias("skill_id"),
                hash_key("_cat_name").alias("skill_cat_id"), "ingested_at")
    )
    unified = from_flat.unionByName(from_grouped)
    valid = unified.join(posting.select("job_id"), "job_id", "left_semi")
    return (
        valid.where(F.col("job_id").isNotNull() & F.col("skill_id").isNotNull())
        .distinct()
        .withColumn("created_at", F.lit(run_ts))
    )
