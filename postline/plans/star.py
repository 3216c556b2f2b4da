"""Star layer over the core models.

Joins to dimensions happen *after* aggregation wherever the question is an
aggregate (R8–R11): the fact is reduced on its foreign keys first (map-side
partial), so the join touches one row per group, whatever the size of the
fact and of the dimension.  Broadcasts are left to AQE, which measures both
sides at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Labels of the flag mini-dimension.
FLAG_LABELS = {
    "work_from_home": ("remote", "on-site", "unknown"),
    "no_degree_mention": ("no degree mentioned", "degree mentioned", "unknown"),
    "health_insurance": ("health insurance", "no health insurance", "unknown"),
}
FLAG_COLUMNS = list(FLAG_LABELS)


def posted_ts(col: str = "posted_date") -> Column:
    return F.try_to_timestamp(F.col(col), F.lit("yyyy-MM-dd HH:mm:ss"))


def date_key(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def _flag_code(c: str) -> Column:
    # tri-state → 0 false, 1 true, 2 unknown
    return F.when(F.col(c).isNull(), 2).when(F.col(c), 1).otherwise(0)


def job_flags_key(cols=FLAG_COLUMNS) -> Column:
    """Key of the flag combination: base-3 digits, so NULL flags get their own rows."""
    return (_flag_code(cols[0]) + 3 * _flag_code(cols[1]) + 9 * _flag_code(cols[2])).cast("int")


def dim_job_flags(posting: DataFrame) -> DataFrame:
    """One row per flag combination present (at most 3³ rows)."""
    def label(c):
        yes, no, unknown = FLAG_LABELS[c]
        return F.when(F.col(c).isNull(), unknown).when(F.col(c), yes).otherwise(no)
    combos = posting.select(*FLAG_COLUMNS).distinct()
    return combos.select(job_flags_key().alias("job_flags_key"), *FLAG_COLUMNS,
                         label("work_from_home").alias("remote_label"),
                         label("no_degree_mention").alias("degree_label"),
                         label("health_insurance").alias("benefits_label"))


def dim_date(posting: DataFrame) -> DataFrame:
    """The posting dates present, with calendar attributes."""
    days = posting.select(F.to_date(posted_ts()).alias("date")).where("date is not null").distinct()
    return days.select(
        date_key(F.col("date")).alias("date_key"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        ((F.dayofweek("date") + 5) % 7 + 1).alias("iso_day_of_week"),
        F.date_format("date", "MMMM").alias("month_name"),
    )


def skill_measures(bridge: DataFrame) -> DataFrame:
    """Bridge rows and distinct skills per job."""
    return bridge.groupBy("job_id").agg(F.count(F.lit(1)).alias("skill_count"),
                                        F.count_distinct("skill_id").alias("distinct_skill_count"))


def fact_job_posting(posting: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per posting; keys, flag key, date key, measures."""
    measures = skill_measures(bridge)
    return posting.join(measures, "job_id", "left").select(
        "job_id", "company_id", "country_id", "platform_id", "schedule_type_id", "rate_type_id", "title_cat_id",
        date_key(posted_ts()).alias("date_key"), job_flags_key().alias("job_flags_key"),
        F.lit(1).alias("job_count"), "salary_year_avg", "salary_hour_avg",
        F.coalesce("skill_count", F.lit(0)).cast("long").alias("skill_count"),
        F.coalesce("distinct_skill_count", F.lit(0)).cast("long").alias("distinct_skill_count"),
    )


def fact_from_staging(stg: DataFrame) -> DataFrame:
    """R1 built inside each staged row: no join, no shuffle.

    A posting and all of its bridge rows come from one staged row, so the
    measures (bridge rows, distinct skills) are array sizes of that row's
    links; the result equals ``fact_job_posting(posting, bridge)``.
    """
    from postline.operators.bridge import job_links, job_posting
    posting = job_posting(stg.withColumn("_links", job_links()), run_ts=None)
    return posting.select(
        "job_id", "company_id", "country_id", "platform_id", "schedule_type_id", "rate_type_id", "title_cat_id",
        date_key(posted_ts()).alias("date_key"), job_flags_key().alias("job_flags_key"),
        F.lit(1).alias("job_count"), "salary_year_avg", "salary_hour_avg",
        F.size("_links").cast("long").alias("skill_count"),
        F.size(F.array_distinct(F.transform("_links", lambda l: l["skill_id"]))).cast("long")
        .alias("distinct_skill_count"),
    )


def fact_job_posting_daily(keyed_landing: DataFrame) -> DataFrame:
    """R2: snapshot grain — one row per posting per ingestion date.

    Keys and measures are those of the day's earliest record; postings without a
    company have no row, as in R1.
    """
    from postline.operators.bridge import job_posting
    rows = job_posting(keyed_landing.withColumn("processed_at", F.lit(None).cast("timestamp")), run_ts=None)
    day = F.to_date("ingested_at")
    keys = ["company_id", "country_id", "platform_id", "schedule_type_id", "rate_type_id", "title_cat_id"]
    record = F.struct(*keys, date_key(posted_ts()).alias("date_key"), job_flags_key().alias("job_flags_key"),
                      "salary_year_avg", "salary_hour_avg")
    first = F.min_by(record, F.struct("ingested_at", "raw_job_id"))
    return (rows.groupBy("job_id", day.alias("ingestion_date"))
            .agg(first.alias("r"), F.count(F.lit(1)).alias("records_seen"))
            .select("job_id", date_key(F.col("ingestion_date")).alias("ingestion_date_key"), "ingestion_date", "r.*",
                    "records_seen"))


def bridge_skill_weight(bridge: DataFrame) -> DataFrame:
    """Job × skill with weight 1/n so each job's skills sum to 1."""
    pairs = bridge.select("job_id", "skill_id").distinct()
    n = F.count(F.lit(1)).over(Window.partitionBy("job_id"))
    return pairs.select("job_id", "skill_id", (F.lit(1.0) / n).alias("weight"))


def weights_from_staging(stg: DataFrame) -> DataFrame:
    """R7 inside each staged row: the job's distinct skills, each weighted 1/n (no shuffle).

    Equals ``bridge_skill_weight(job_skill)``: all bridge rows of a job come
    from its staged row.
    """
    from postline.operators.bridge import job_links
    skills = F.array_distinct(F.transform(job_links(), lambda l: l["skill_id"]))
    valid = stg.where(F.nullif(F.trim("company_name"), F.lit("")).isNotNull())
    return (valid.select(F.md5("business_key").alias("job_id"), skills.alias("_s"))
            .select("job_id", F.explode("_s").alias("skill_id"), (F.lit(1.0) / F.size("_s")).alias("weight")))


def _money_avg(col: str, alias: str) -> list[Column]:
    """Average of a 2-decimal amount, rounded half-up to cents in integer arithmetic
    (exact and engine-independent), then given in currency units."""
    avg_cents = F.expr(f"(2 * sum(cast({col} * 100 as bigint)) + count({col})) div (2 * count({col}))")
    return [F.when(F.count(col) > 0, avg_cents / F.lit(100.0)).alias(alias)]


def jobs_per_month(posting: DataFrame, company: DataFrame) -> DataFrame:
    """Postings per company per month (aggregate on the key, then name it)."""
    per_key = (posting.select("company_id", F.date_trunc("month", posted_ts()).alias("month"))
               .groupBy("company_id", "month").agg(F.count(F.lit(1)).alias("job_count")))
    return per_key.join(company.select("company_id", "company_name"), "company_id", "left").select(
        "company_name", "month", "job_count")


def top_skills_by_title(posting: DataFrame, bridge: DataFrame, skill: DataFrame,
                        titles: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most common skills of each title category (ties by name)."""
    pairs = bridge.select("job_id", "skill_id").distinct()
    per = (pairs.join(posting.select("job_id", "title_cat_id"), "job_id")
           .groupBy("title_cat_id", "skill_id").agg(F.count(F.lit(1)).alias("job_count")))
    named = per.join(skill.select("skill_id", "skill_name"), "skill_id")
    w = Window.partitionBy("title_cat_id").orderBy(F.col("job_count").desc(), F.col("skill_name").asc())
    top = named.withColumn("skill_rank", F.row_number().over(w)).where(F.col("skill_rank") <= k)
    return top.join(titles.select("title_cat_id", "job_title_short"), "title_cat_id", "left").select(
        "job_title_short", "skill_rank", "skill_name", "job_count")


def top_skills_from_staging(stg: DataFrame, k: int = 5) -> DataFrame:
    """R9 from the staged rows: title and distinct skills sit in the same row.

    One count per (title, skill) with a map-side partial, then the ranks; no join,
    equal to ``top_skills_by_title``.
    """
    from postline.functions.columns import canon
    from postline.operators.nested import flat_skill_names, typed_skill_pairs
    none = F.array().cast("array<string>")
    names = F.array_distinct(F.concat(
        F.coalesce(flat_skill_names(F.col("job_skills_array")), none),
        F.coalesce(F.transform(typed_skill_pairs(F.col("job_type_skills")), lambda p: p["skill_name"]), none)))
    valid = stg.where(F.nullif(F.trim("company_name"), F.lit("")).isNotNull())
    counts = (valid.select(canon("job_title_short").alias("job_title_short"), F.explode(names).alias("skill_name"))
              .groupBy("job_title_short", "skill_name").agg(F.count(F.lit(1)).alias("job_count")))
    w = Window.partitionBy("job_title_short").orderBy(F.col("job_count").desc(), F.col("skill_name").asc())
    return counts.withColumn("skill_rank", F.row_number().over(w)).where(F.col("skill_rank") <= k).select(
        "job_title_short", "skill_rank", "skill_name", "job_count")


def avg_salary_country_platform(posting: DataFrame, country: DataFrame, platform: DataFrame) -> DataFrame:
    """Average yearly pay by country and platform, with range and counts."""
    per_key = (posting.where(F.col("salary_year_avg").isNotNull())
               .groupBy("country_id", "platform_id")
               .agg(F.count(F.lit(1)).alias("job_count"),
                    *_money_avg("salary_year_avg", "avg_salary_year"),
                    F.min("salary_year_avg").alias("min_salary_year"),
                    F.max("salary_year_avg").alias("max_salary_year")))
    return (per_key.join(country.select("country_id", "country_name"), "country_id", "left")
            .join(platform.select("platform_id", "platform_name"), "platform_id", "left")
            .select("country_name", "platform_name", "job_count", "avg_salary_year",
                    "min_salary_year", "max_salary_year"))


def remote_vs_onsite(posting: DataFrame) -> DataFrame:
    """Volume and pay of remote, on-site and unknown postings."""
    yes, no, unknown = FLAG_LABELS["work_from_home"]
    label = F.when(F.col("work_from_home").isNull(), unknown).when(F.col("work_from_home"), yes).otherwise(no)
    return posting.groupBy(label.alias("remote_label")).agg(
        F.count(F.lit(1)).alias("job_count"),
        F.count("salary_year_avg").alias("jobs_with_year_salary"),
        *_money_avg("salary_year_avg", "avg_salary_year"),
        F.count("salary_hour_avg").alias("jobs_with_hour_salary"),
        *_money_avg("salary_hour_avg", "avg_salary_hour"),
    )


#: The groupings of the cube, in one expand: months by dimension, the dimensions alone, country by platform, all.
CUBE_SETS = [("month", "company_id"), ("month", "country_id"), ("month", "platform_id"), ("country_id", "platform_id"),
             ("month",), ("company_id",), ()]


def posting_cube(posting: DataFrame) -> DataFrame:
    """R8–R11 in one pass: volume and pay for every grouping of ``CUBE_SETS``.

    ``grouping`` has a bit for each of (month, company, country, platform) that the row is a
    total over, the month the highest, so a total and a key that is null are told apart.
    """
    keys = ["month", "company_id", "country_id", "platform_id"]
    rows = posting.withColumn("month", F.date_trunc("month", posted_ts()))
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in CUBE_SETS], *keys)
    return grouped.agg(F.grouping_id().cast("long").alias("grouping"), F.count(F.lit(1)).alias("job_count"),
                       *_money_avg("salary_year_avg", "avg_salary_year"),
                       F.count("salary_year_avg").alias("jobs_with_year_salary")).select(
        "grouping", *keys, "job_count", "jobs_with_year_salary", "avg_salary_year")


def validity_intervals(daily: DataFrame) -> DataFrame:
    """R2 as intervals: from and to of each unchanged record of a posting.

    ``daily`` has a row per posting and ingestion date.  Dates that follow each other with
    the same record are one interval; it ends the day before the next record of the posting
    begins, the last one is open (null).  A window over one posting's dates: at most a row per day.
    """
    record = [c for c in daily.columns if c not in ("job_id", "ingestion_date", "ingestion_date_key", "records_seen")]
    by_day = Window.partitionBy("job_id").orderBy("ingestion_date")
    packed = F.struct(*record)
    begins = F.row_number().over(by_day) == 1
    changed = ~packed.eqNullSafe(F.lag(packed).over(by_day))
    numbered = daily.withColumn("_new", (begins | changed).cast("int")).withColumn(
        "span_no", F.sum("_new").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("job_id", "span_no", *record).agg(
        F.min("ingestion_date").alias("valid_from"), F.count(F.lit(1)).alias("days_seen"),
        F.sum("records_seen").alias("records_seen"))
    following = Window.partitionBy("job_id").orderBy("span_no")
    return spans.withColumn("valid_to", F.date_sub(F.lead("valid_from").over(following), 1)).select(
        "job_id", "span_no", *record, "valid_from", "valid_to", "days_seen", "records_seen")


def moving_volume(posting: DataFrame, days: int = 28) -> DataFrame:
    """R8 moving: postings and their mean yearly pay over the last ``days`` days, per company and posting date.

    Days are aggregated first, so the range frame runs over a row per day, also for a company that
    holds a third of all postings.  Amounts are cents, so sums are exact.
    """
    cents = F.sum((F.col("salary_year_avg") * 100).cast("long"))
    per_day = (posting.select("company_id", F.to_date(posted_ts()).alias("posting_date"), "salary_year_avg")
               .where("posting_date is not null").groupBy("company_id", "posting_date")
               .agg(F.count(F.lit(1)).alias("jobs"), F.count("salary_year_avg").alias("paid"), F.coalesce(cents, F.lit(0)).alias("cents")))
    frame = (Window.partitionBy("company_id").orderBy(F.unix_date("posting_date")).rangeBetween(1 - days, 0))
    moved = per_day.select("company_id", "posting_date", "jobs", *[F.sum(c).over(frame).alias(f"{c}_moving") for c in ("jobs", "paid", "cents")])
    mean = F.when(F.col("paid_moving") > 0, F.expr("(2 * cents_moving + paid_moving) div (2 * paid_moving)") / 100.0)
    return moved.select("company_id", "posting_date", "jobs", "jobs_moving", "paid_moving", mean.alias("avg_salary_moving"))
