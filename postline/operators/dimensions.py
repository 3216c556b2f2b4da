"""Hash-keyed dimensions.

A dimension is the distinct canonical names of one column.  ``distinct`` is a
hash aggregate with a map-side partial, so a hot name (one company with a
third of all postings) is collapsed inside each task before the shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.functions.columns import canon, hash_key

# dimension → (staging column, id column, name column)
DIMENSIONS = {
    "company": ("company_name", "company_id", "company_name"),
    "country": ("job_country", "country_id", "country_name"),
    "platform": ("job_via", "platform_id", "platform_name"),
    "schedule_type": ("job_schedule_type", "schedule_type_id", "schedule_name"),
    "salary_rate_type": ("salary_rate", "rate_type_id", "rate_name"),
    "job_title_category": ("job_title_short", "title_cat_id", "job_title_short"),
}


def build_dimension(src: DataFrame, column: str, id_name: str, name_name: str,
                    run_ts: datetime) -> DataFrame:
    """Distinct ``canon(column)`` with ``md5`` id."""
    names = src.select(canon(column).alias(name_name)).where(F.col(name_name).isNotNull()).distinct()
    return names.select(hash_key(name_name).alias(id_name), name_name, F.lit(run_ts).alias("created_at"))


def dimension(stg: DataFrame, name: str, run_ts: datetime) -> DataFrame:
    column, id_name, name_name = DIMENSIONS[name]
    return build_dimension(stg, column, id_name, name_name, run_ts)


def skill(flat: DataFrame, grouped: DataFrame, run_ts: datetime) -> DataFrame:
    """Skills of both exploded relations (UNION = distinct)."""
    names = flat.select("skill_name").union(grouped.select("skill_name"))
    return build_dimension(names, "skill_name", "skill_id", "skill_name", run_ts)


def skill_category(grouped: DataFrame, run_ts: datetime) -> DataFrame:
    """Categories of the grouped relation."""
    return build_dimension(grouped, "skill_category", "skill_cat_id", "category_name", run_ts)


def sorted_by(df: DataFrame, col: str) -> DataFrame:
    """O1: total order by a column (range-partitioned sort)."""
    return df.orderBy(F.col(col).asc_nulls_last())
