"""Column sets and fixed schemas of the relations (landing, ledger, models)."""

from __future__ import annotations

from pyspark.sql import types as T

# Posting columns as they arrive in a source file, in file order.
TEXT_COLUMNS = [
    "job_title_short", "job_title", "job_location", "job_via", "job_schedule_type",
    "search_location", "job_posted_date", "job_country", "salary_rate", "company_name",
]
BOOL_COLUMNS = ["job_work_from_home", "job_no_degree_mention", "job_health_insurance"]
DECIMAL_COLUMNS = {"salary_year_avg": (12, 2), "salary_hour_avg": (8, 2)}
LIST_COLUMN = "job_skills"
MAP_COLUMN = "job_type_skills"

SOURCE_COLUMNS = [
    "job_title_short", "job_title", "job_location", "job_via", "job_schedule_type",
    "job_work_from_home", "search_location", "job_posted_date", "job_no_degree_mention",
    "job_health_insurance", "job_country", "salary_rate", "salary_year_avg",
    "salary_hour_avg", "company_name", "job_skills", "job_type_skills",
]

# Columns of the business key, in key order.  Skills are not part of it, nor
# are job_title_short and search_location.
BUSINESS_KEY_ORDER = [
    "company_name", "job_title", "job_location", "job_posted_date", "job_schedule_type",
    "job_via", "salary_year_avg", "salary_hour_avg", "job_work_from_home",
    "job_no_degree_mention", "job_health_insurance", "job_country", "salary_rate",
]
BUSINESS_KEY_TEXT = [c for c in BUSINESS_KEY_ORDER if c in TEXT_COLUMNS]
BUSINESS_KEY_VALUES = [c for c in BUSINESS_KEY_ORDER if c not in TEXT_COLUMNS]

SKILLS_TYPE = T.ArrayType(T.StringType())
TYPE_SKILLS_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

LANDING_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), False)]
    + [
        T.StructField(
            c,
            T.BooleanType() if c in BOOL_COLUMNS
            else T.DecimalType(*DECIMAL_COLUMNS[c]) if c in DECIMAL_COLUMNS
            else SKILLS_TYPE if c == LIST_COLUMN
            else TYPE_SKILLS_TYPE if c == MAP_COLUMN
            else T.StringType(),
        )
        for c in SOURCE_COLUMNS
    ]
    + [
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("file_md5", T.StringType()),
    ]
)

LEDGER_STATUSES = ["completed", "skipped", "failed"]

LEDGER_SCHEMA = T.StructType([
    T.StructField("file_md5", T.StringType(), False),
    T.StructField("file_path", T.StringType(), False),
    T.StructField("source_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("total_rows", T.LongType(), False),
    T.StructField("inserted_rows", T.LongType(), False),
    T.StructField("parse_warnings", T.LongType(), False),
    T.StructField("job_skills_missing", T.LongType(), False),
    T.StructField("job_skills_invalid", T.LongType(), False),
    T.StructField("job_type_skills_missing", T.LongType(), False),
    T.StructField("job_type_skills_invalid", T.LongType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("finished_at", T.TimestampType()),
])

# Entries as written: the ledger's columns, the run that wrote them and the id before the file's first row.
ENTRY_SCHEMA = T.StructType(LEDGER_SCHEMA.fields + [
    T.StructField("run_id", T.StringType(), False),
    T.StructField("id_before", T.LongType(), False),
])
# Where each read partition of a landed file begins: row number of its first row, and the id before that row.
SEGMENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("file_md5", T.StringType(), False),
    T.StructField("read_part", T.LongType(), False),
    T.StructField("first_row", T.LongType(), False),
    T.StructField("id_before", T.LongType(), False),
])
