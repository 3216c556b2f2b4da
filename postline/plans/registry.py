"""Registered queries: name → (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and reads the driver tables there
(or relations Spark derives from them), so its work grows with the data.
Outputs hold no arrays or maps: nested values are flattened to text so the
oracle can produce the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline import oracle
from postline.functions.columns import map_text
from postline.operators import asof, bridge, dedup, dimensions, nested
from postline.operators import quality
from postline.operators.normalise import normalise_postings
from postline.plans import csv_loads, doc_ledger, incremental, ingest, models, profile, star
from postline.session import Scratch, shuffles_released, stored
from postline.sources import ledger
from postline.sources.driver_tables import postings_source
from postline.schemas import BOOL_COLUMNS, DECIMAL_COLUMNS, TEXT_COLUMNS
from postline.sources.driver_tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _raw(spark, sf_dir, profile=False):
    return models.landing_from_tables(spark, sf_dir, profile=profile)


def _models(spark, sf_dir):
    return models.build_models(_raw(spark, sf_dir), models.RUN_TS)


def _staging(spark, sf_dir):
    return models.staging(_raw(spark, sf_dir), models.RUN_TS)


def _postings(spark, sf_dir):
    """Dimensions of posting columns and the posting entity; no skill is parsed."""
    return models.posting_models(dedup.posting_core(_raw(spark, sf_dir), models.RUN_TS), models.RUN_TS)


def _shared(spark, sf_dir):
    """Models for queries that combine several of them (staging stored once)."""
    return models.shared_models(_raw(spark, sf_dir), models.RUN_TS)


# --- landing: P1–P6, E1–E3 -------------------------------------------------

@register("landing_text", oracle.q(f"SELECT id, {', '.join(TEXT_COLUMNS)} FROM landing"))
def landing_text(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", *TEXT_COLUMNS)


@register("landing_values", oracle.q(
    f"SELECT id, {', '.join(BOOL_COLUMNS + list(DECIMAL_COLUMNS))}, ingested_at FROM landing"))
def landing_values(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", *BOOL_COLUMNS, *DECIMAL_COLUMNS, "ingested_at")


@register("parse_nested", oracle.q("""
SELECT id, array_to_string(skills_list, '|') AS skills_text,
  array_to_string(list_transform(type_entries, lambda e: e.key || ':' || array_to_string(e.value, ',')), ';') AS type_skills_text,
  job_skills_missing, job_skills_invalid, job_type_skills_missing, job_type_skills_invalid
FROM landing"""))
def parse_nested(spark, sf_dir):
    raw = _raw(spark, sf_dir, profile=True)
    return raw.select(
        "id",
        F.array_join("job_skills", "|").alias("skills_text"),
        map_text("job_type_skills").alias("type_skills_text"),
        "job_skills_missing", "job_skills_invalid", "job_type_skills_missing", "job_type_skills_invalid",
    )


# --- keys and dedup: P9, A1–A5, W1, J1, J2 ---------------------------------

@register("business_key", oracle.q("SELECT raw_job_id, business_key FROM keyed"))
def business_key_q(spark, sf_dir):
    return dedup.with_business_key(_raw(spark, sf_dir)).select("raw_job_id", "business_key")


_KEEP_FIRST_SQL = oracle.q("SELECT business_key, raw_job_id, ingested_at FROM prim")


@register("keep_first_window", _KEEP_FIRST_SQL)
def keep_first_window_q(spark, sf_dir):
    keyed = dedup.with_business_key(_raw(spark, sf_dir)).select("business_key", "raw_job_id", "ingested_at")
    return dedup.keep_first_window(keyed)


@register("keep_first_minby", _KEEP_FIRST_SQL)
def keep_first_minby_q(spark, sf_dir):
    keyed = dedup.with_business_key(_raw(spark, sf_dir)).select("business_key", "raw_job_id", "ingested_at")
    return dedup.keep_first(keyed, cols=["raw_job_id", "ingested_at"])


@register("skill_sets", oracle.q(
    "SELECT business_key, array_to_string(skills, '|') AS skills_text FROM skill_sets"))
def skill_sets_q(spark, sf_dir):
    keyed = dedup.with_business_key(_raw(spark, sf_dir))
    return dedup.skill_sets(keyed).select("business_key", F.array_join("skills", "|").alias("skills_text"))


@register("type_skill_sets", oracle.q(
    "SELECT business_key, category, array_to_string(skills, '|') AS skills_text FROM type_sets"))
def type_skill_sets_q(spark, sf_dir):
    keyed = dedup.with_business_key(_raw(spark, sf_dir))
    return dedup.type_skill_sets(keyed).select("business_key", "category",
                                               F.array_join("skills", "|").alias("skills_text"))


_STG_COLS = ("raw_job_id, business_key, " + oracle.POSTING_COLS
             + ", array_to_string(skills_arr, '|') AS skills_text, type_text AS type_skills_text,"
             " ingested_at, processed_at")


def _stg_out(stg: DataFrame) -> DataFrame:
    return stg.select(
        *[c for c in stg.columns if c not in ("job_skills_array", "job_type_skills", "ingested_at", "processed_at")],
        F.array_join("job_skills_array", "|").alias("skills_text"),
        map_text("job_type_skills").alias("type_skills_text"),
        "ingested_at", "processed_at",
    )


@register("stg_raw_jobs", oracle.q(f"SELECT {_STG_COLS} FROM stg"))
def stg_raw_jobs_q(spark, sf_dir):
    return _stg_out(_staging(spark, sf_dir))


@register("stg_raw_jobs_joined", oracle.q(f"SELECT {_STG_COLS} FROM stg"))
def stg_raw_jobs_joined_q(spark, sf_dir):
    return _stg_out(dedup.dedup_merge_joined(_raw(spark, sf_dir), models.RUN_TS))


# --- exploded relations: E4–E8, P10 ----------------------------------------

@register("stg_job_skills_exploded", oracle.q("SELECT * FROM flat"))
def stg_job_skills_exploded_q(spark, sf_dir):
    return _models(spark, sf_dir)["stg_job_skills_exploded"]


@register("stg_job_type_skills_exploded", oracle.q("SELECT * FROM grouped"))
def stg_job_type_skills_exploded_q(spark, sf_dir):
    return _models(spark, sf_dir)["stg_job_type_skills_exploded"]


@register("json_props_explode", """
SELECT event_id, j.key AS prop_key, CAST(j.value AS BIGINT) AS prop_value
FROM events, json_each(events.props) AS j""")
def json_props_explode_q(spark, sf_dir):
    return nested.json_props_exploded(read_table(spark, sf_dir, "events"))


@register("json_items", """
WITH c AS (SELECT event_id, CASE event_id % 8
    WHEN 0 THEN props WHEN 1 THEN '{"k":[' || event_id || ',"a b",null," ",[1,2],{"y":true}]}'
    WHEN 2 THEN '{"k":" txt ' || event_id || '"," ":1,"l":true}' WHEN 3 THEN '{"k":{"x":' || event_id || '},"n":-7}'
    WHEN 4 THEN '{"k":null,"m":[]}' WHEN 5 THEN '{" k ":' || event_id || '.5}'
    WHEN 6 THEN '[1,' || event_id || ']' ELSE '{"k": ' END AS cell FROM events),
e AS (SELECT event_id, trim(j.key) AS key, j.value AS v FROM (SELECT * FROM c WHERE json_valid(cell) AND json_type(cell) = 'OBJECT') c, json_each(c.cell) j),
i AS (SELECT event_id, key, unnest(CASE WHEN json_type(v) = 'ARRAY' THEN CAST(v AS JSON[]) ELSE [v] END) AS item FROM e WHERE key <> '')
SELECT event_id, key, trim(item ->> '$') AS item FROM i WHERE trim(item ->> '$') <> ''""")
def json_items_q(spark, sf_dir):
    """P15 on raw JSON: event properties with cells of every type."""
    n = F.col("event_id").cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    kinds = [F.col("props"), text('{"k":[', n, ',"a b",null," ",[1,2],{"y":true}]}'), text('{"k":" txt ', n, '"," ":1,"l":true}'),
             text('{"k":{"x":', n, '},"n":-7}'), text('{"k":null,"m":[]}'), text('{" k ":', n, ".5}"), text("[1,", n, "]"), text('{"k": ')]
    cell = F.element_at(F.array(*kinds), (F.col("event_id") % 8 + 1).cast("int"))
    return nested.json_items(read_table(spark, sf_dir, "events").select("event_id", cell.alias("cell")), "event_id", "cell")


# --- dimensions, entity, bridge: M4–M13 -------------------------------------

def _dim_query(name: str) -> Query:
    def run(spark, sf_dir):
        if name == "skill":
            return models.skill_dimension(_raw(spark, sf_dir), models.RUN_TS)
        return (_models if name.startswith("skill") else _postings)(spark, sf_dir)[name]
    run.__name__ = f"{name}_q"
    return run


for _name in ["company", "country", "platform", "schedule_type", "salary_rate_type",
              "job_title_category", "skill", "skill_category"]:
    register(f"dim_{_name}", oracle.q(f"SELECT * FROM {_name}"))(_dim_query(_name))


@register("dim_skill_sorted", oracle.q("SELECT * FROM skill ORDER BY skill_name"))
def dim_skill_sorted_q(spark, sf_dir):
    """O1: the skill dimension in name order (range-partitioned sort)."""
    return dimensions.sorted_by(models.skill_dimension(_raw(spark, sf_dir), models.RUN_TS), "skill_name")


@register("job_posting", oracle.q("SELECT * FROM job_posting"))
def job_posting_q(spark, sf_dir):
    return _postings(spark, sf_dir)["job_posting"]


@register("job_skill", oracle.q("SELECT * FROM job_skill"))
def job_skill_q(spark, sf_dir):
    return _models(spark, sf_dir)["job_skill"]


@register("job_skill_joined", oracle.q("SELECT * FROM job_skill"))
def job_skill_joined_q(spark, sf_dir):
    m = _shared(spark, sf_dir)
    return bridge.job_skill_joined(m["stg_job_skills_exploded"], m["stg_job_type_skills_exploded"], m["skill"],
                                   m["skill_category"], m["job_posting"], models.RUN_TS)


# --- incremental builds: S12, M1 ---------------------------------------------

def _two_builds(spark, sf_dir, name: str) -> DataFrame:
    """A model of the version that a second build makes, from the loads of the first day and then those of the others."""
    first = F.col("ingested_at") < F.lit(datetime(2024, 1, 2))
    with Scratch(spark) as scratch, shuffles_released(spark):
        raw = scratch.cut(_raw(spark, sf_dir), "landing", **incremental.PACKED)  # both builds read it
        for part in (~first, first):  # the later loads first, so earlier records arrive late
            incremental.apply_rows(spark, f"{scratch.root}/models", raw.where(part), models.RUN_TS)
        model = incremental.read_models(spark, f"{scratch.root}/models", [name])[name]
        return stored(_stg_out(model) if name == "stg_raw_jobs" else model, **incremental.PACKED)


@register("incremental_stg_raw_jobs", oracle.q(f"SELECT {_STG_COLS} FROM stg"))
def incremental_stg_raw_jobs_q(spark, sf_dir):
    return _two_builds(spark, sf_dir, "stg_raw_jobs")


@register("incremental_job_skill", oracle.q("SELECT * FROM job_skill"))
def incremental_job_skill_q(spark, sf_dir):
    return _two_builds(spark, sf_dir, "job_skill")


# --- ingest statistics: S9, S10 (each load batch is one source file) --------

@register("ingest_stats", oracle.q("""
SELECT batch,
  count(*) AS total_rows, count(*) AS inserted_rows,
  CAST(sum(CAST(job_skills_invalid AS INTEGER)) + sum(CAST(job_type_skills_invalid AS INTEGER)) AS BIGINT) AS parse_warnings,
  CAST(sum(CAST(job_skills_missing AS INTEGER)) AS BIGINT) AS job_skills_missing,
  CAST(sum(CAST(job_skills_invalid AS INTEGER)) AS BIGINT) AS job_skills_invalid,
  CAST(sum(CAST(job_type_skills_missing AS INTEGER)) AS BIGINT) AS job_type_skills_missing,
  CAST(sum(CAST(job_type_skills_invalid AS INTEGER)) AS BIGINT) AS job_type_skills_invalid
FROM landing GROUP BY batch"""))
def ingest_stats_q(spark, sf_dir):
    src = postings_source(spark, sf_dir)
    typed = normalise_postings(src, keep=["batch"], profile=True)
    return ingest.ingest_stats(typed, by=["batch"])


# --- the ingest job over CSV files: S1–S7, S9–S11 -----------------------------

_VALUES = (f"{', '.join(TEXT_COLUMNS + BOOL_COLUMNS + list(DECIMAL_COLUMNS))}, array_to_string(skills_list, '|') AS skills_text, "
           "array_to_string(list_transform(type_entries, lambda e: e.key || ':' || array_to_string(e.value, ',')), ';') "
           "AS type_skills_text")


@register("ingest_landed", oracle.q(f"SELECT {_VALUES} FROM landing"))
def ingest_landed_q(spark, sf_dir):
    return csv_loads.landed_values(spark, sf_dir)


@register("ingest_ids", oracle.q("""
SELECT count(DISTINCT batch) AS files, CAST(count(DISTINCT batch) AS BIGINT) AS dense_files, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(1 AS BIGINT) AS min_id, count(*) AS max_id, TIMESTAMP '2024-05-01 12:00:00' AS loaded_at FROM landing"""))
def ingest_ids_q(spark, sf_dir):
    return csv_loads.landed_ids(spark, sf_dir)


@register("ingest_runs", oracle.q("""
SELECT TIMESTAMP '2024-05-01 12:00:00' AS started_at, 'completed' AS status, count(DISTINCT batch) AS files,
  count(*) AS total_rows, count(*) AS inserted_rows,
  count(*) FILTER (job_skills_invalid) + count(*) FILTER (job_type_skills_invalid) AS parse_warnings,
  count(*) FILTER (job_skills_missing) AS job_skills_missing, count(*) FILTER (job_skills_invalid) AS job_skills_invalid,
  count(*) FILTER (job_type_skills_missing) AS job_type_skills_missing,
  count(*) FILTER (job_type_skills_invalid) AS job_type_skills_invalid
FROM landing
UNION ALL
SELECT TIMESTAMP '2024-06-01 12:00:00', 'skipped', count(DISTINCT batch), 0, 0, 0, 0, 0, 0, 0 FROM landing"""))
def ingest_runs_q(spark, sf_dir):
    return csv_loads.run_entries(spark, sf_dir)


@register("ingest_smoke", oracle.q(f"""
SELECT {_VALUES}, CAST((SELECT count(*) FROM landing) AS BIGINT) AS whole_rows, CAST(0 AS BIGINT) AS whole_skipped
FROM (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY id) AS place FROM landing) WHERE place <= {csv_loads.SAMPLE_ROWS}"""))
def ingest_smoke_q(spark, sf_dir):
    return csv_loads.sampled_values(spark, sf_dir)


@register("ingest_scan", r"""
SELECT md5(content) AS file_md5, CAST(strlen(content) AS BIGINT) AS size, 'job_title,job_via' AS header, false AS multiline,
  CAST(NULL AS VARCHAR) AS problem
FROM (SELECT o_orderkey % 16 AS part, 'job_title,job_via' || chr(10) ||
    string_agg('"' || o_orderkey || '","' || o_orderpriority || '"' || chr(10), '' ORDER BY o_orderkey) AS content
  FROM orders GROUP BY 1)""")
def ingest_scan_q(spark, sf_dir):
    return csv_loads.scanned(spark, sf_dir)


@register("ledger_fold", """
WITH e AS (SELECT md5(text) AS file_md5, 'documents/' || source || '/' || doc_id || '.txt' AS file_path, source AS source_name,
  ['failed', 'skipped', 'completed', 'failed'][(doc_id + r) % 4 + 1] AS status, n_chars AS total_rows,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(r AS INTEGER)) + to_seconds(doc_id) AS finished_at, 'run' || r AS run_id
  FROM documents CROSS JOIN (SELECT unnest([1, 2, 3]) AS r)),
t AS (SELECT *, row_number() OVER (PARTITION BY file_md5 ORDER BY finished_at, run_id, file_path) AS early,
  row_number() OVER (PARTITION BY file_md5 ORDER BY finished_at DESC, run_id DESC, file_path DESC) AS late,
  row_number() OVER (PARTITION BY file_md5, status ORDER BY finished_at, run_id, file_path) AS within
  FROM e WHERE status <> 'skipped'),
k AS (SELECT *, row_number() OVER (PARTITION BY file_md5 ORDER BY status = 'completed' AND within = 1 DESC, late) AS pick FROM t
  WHERE (status = 'completed' AND within = 1) OR late = 1)
SELECT k.file_md5, f.file_path, f.source_name, k.status, k.total_rows, k.finished_at, k.run_id
FROM k JOIN t f ON f.file_md5 = k.file_md5 AND f.early = 1 WHERE k.pick = 1""")
def ledger_fold_q(spark, sf_dir):
    """S7 as the ingest does it: the ledger from the entries of three runs over the documents."""
    return ledger.fold_entries(doc_ledger.entries_of_runs(spark, sf_dir)).select(
        "file_md5", "file_path", "source_name", "status", "total_rows", "finished_at", "run_id")


_PROFILED = ["company_name", "job_country", "job_title", "salary_year_avg", "salary_hour_avg"]


@register("sketch_profile", oracle.q(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_nulls,
  count(DISTINCT {c}) AS exact_distinct, true AS distinct_holds, true AS ranks_hold FROM landing""" for c in _PROFILED)))
def sketch_profile_q(spark, sf_dir):
    """Sketches of every load merged: their figures hold within 4 % of the distinct values and 2 % of the ranks."""
    rows = profile.measured(_raw(spark, sf_dir), "ingested_at", _PROFILED)
    return rows.select("column", "n_rows", "n_nulls", "exact_distinct", (F.col("distinct_error") <= 0.04).alias("distinct_holds"),
                       (F.coalesce("rank_error", F.lit(0.0)) <= 0.02).alias("ranks_hold"))


# --- quality: Q1–Q8 ----------------------------------------------------------

def _tables(spark, sf_dir):
    return _shared(spark, sf_dir)


@register("quality_report", oracle.quality_report_sql(quality.model_checks()))
def quality_report_q(spark, sf_dir):
    return quality.QualitySuite().report(models.checked_models(_raw(spark, sf_dir), models.RUN_TS))


@register("q_unique_offenders", oracle.q("""
SELECT skill_assignment_id, count(*) AS n_records FROM flat
WHERE skill_assignment_id IS NOT NULL GROUP BY skill_assignment_id HAVING count(*) > 1"""))
def q_unique_offenders(spark, sf_dir):
    return quality.unique(_tables(spark, sf_dir)["stg_job_skills_exploded"], "skill_assignment_id")


@register("q_not_null_offenders", oracle.q(
    "SELECT job_id, title_cat_id, rate_type_id FROM job_posting WHERE rate_type_id IS NULL"))
def q_not_null_offenders(spark, sf_dir):
    posting = _postings(spark, sf_dir)["job_posting"]
    return quality.not_null(posting, "rate_type_id").select("job_id", "title_cat_id", "rate_type_id")


@register("q_orphans", oracle.q("""
SELECT job_via, count(*) AS n_records FROM landing l
WHERE job_via IS NOT NULL AND NOT EXISTS (SELECT 1 FROM platform d WHERE d.platform_name = l.job_via)
GROUP BY job_via"""))
def q_orphans(spark, sf_dir):
    """Platform names as they were landed against the cleaned names of the dimension."""
    platform = _postings(spark, sf_dir)["platform"]
    return quality.relationships(_raw(spark, sf_dir), "job_via", platform, "platform_name")


@register("q_orphans_customers", """
SELECT c_custkey, count(*) AS n_records FROM customer c
WHERE c_custkey IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
GROUP BY c_custkey""")
def q_orphans_customers(spark, sf_dir):
    """Customers without an order that is in progress."""
    orders = read_table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return quality.relationships(read_table(spark, sf_dir, "customer"), "c_custkey", orders, "o_custkey")


@register("q_orphans_filtered", """
SELECT c_custkey, count(*) AS n_records FROM customer c
WHERE c_custkey IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
GROUP BY c_custkey""")
def q_orphans_filtered(spark, sf_dir):
    """The same with filters of a fixed size in front of the anti join."""
    orders = read_table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return quality.relationships_filtered(read_table(spark, sf_dir, "customer"), "c_custkey", orders, "o_custkey")


@register("q_composite_key", oracle.q("""
SELECT job_id, skill_id, count(*) AS duplicate_count FROM job_skill
GROUP BY job_id, skill_id HAVING count(*) > 1"""))
def q_composite_key(spark, sf_dir):
    """Skills that a posting links more than once, whatever the category."""
    return quality.composite_key_unique(_models(spark, sf_dir)["job_skill"], ["job_id", "skill_id"])


@register("q_bridge_triples", oracle.q("""
SELECT job_id, skill_id, NULL::VARCHAR AS skill_cat_id, count(*) AS duplicate_count FROM job_skill
GROUP BY job_id, skill_id HAVING count(*) > 1"""))
def q_bridge_triples(spark, sf_dir):
    """Q7 on a bridge that has lost its categories."""
    dirty = _models(spark, sf_dir)["job_skill"].withColumn("skill_cat_id", F.lit(None).cast("string"))
    return quality.bridge_unique_triples(dirty)


@register("q_composite_key_raw", """
SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_composite_key_raw(spark, sf_dir):
    return quality.composite_key_unique(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("q_dates_not_future", oracle.q(
    "SELECT count(*) AS future_dates FROM stg WHERE ingested_at IS NOT NULL AND ingested_at > "
    "TIMESTAMP '2024-01-02 00:00:00' HAVING count(*) > 0"))
def q_dates_not_future(spark, sf_dir):
    core = dedup.posting_core(_raw(spark, sf_dir), models.RUN_TS)
    return quality.dates_not_future(core, "ingested_at", datetime(2024, 1, 2))


@register("q_dates_not_future_orders", """
SELECT count(*) AS future_dates FROM orders WHERE o_orderdate IS NOT NULL AND o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
HAVING count(*) > 0""")
def q_dates_not_future_orders(spark, sf_dir):
    return quality.dates_not_future(read_table(spark, sf_dir, "orders"), "o_orderdate", datetime(1998, 1, 1))


@register("q_posting_matches_staging", oracle.q("""
SELECT business_key FROM merged WHERE trim(coalesce(f.company_name, '')) <> '' AND business_key NOT IN (
  SELECT business_key FROM keyed WHERE ingested_at < TIMESTAMP '2024-01-02 00:00:00')"""))
def q_posting_matches_staging(spark, sf_dir):
    """Q6 with postings built from the loads of the first day alone."""
    raw = _raw(spark, sf_dir)
    early = dedup.posting_core(raw.where(F.col("ingested_at") < F.lit(datetime(2024, 1, 2))), models.RUN_TS)
    posting = models.posting_models(early, models.RUN_TS)["job_posting"]
    return quality.posting_matches_staging(dedup.posting_core(raw, models.RUN_TS), posting)


# --- ledger over document "files": S3, S4, S7, S8, O2, J10 ------------------

@register("files_fingerprint", oracle.LEDGER_CTES + "SELECT file_path, file_md5, source_name, total_rows FROM files")
def files_fingerprint_q(spark, sf_dir):
    return doc_ledger.document_files(spark, sf_dir)


@register("ledger_pending", oracle.LEDGER_CTES + "SELECT file_md5, file_path, source_name FROM pending")
def ledger_pending_q(spark, sf_dir):
    files_ = doc_ledger.document_files(spark, sf_dir)
    prior = doc_ledger.prior_ledger(spark, sf_dir)
    return ledger.pending_files(files_, prior).select("file_md5", "file_path", "source_name")


@register("ledger_already_loaded", oracle.LEDGER_CTES + """
SELECT f.file_path, f.file_md5 FROM files f WHERE EXISTS
  (SELECT 1 FROM prior p WHERE p.file_md5 = f.file_md5 AND p.status = 'completed')""")
def ledger_already_loaded_q(spark, sf_dir):
    files_ = doc_ledger.document_files(spark, sf_dir)
    return ledger.already_loaded(files_, doc_ledger.prior_ledger(spark, sf_dir)).select("file_path", "file_md5")


@register("ledger_upsert", oracle.LEDGER_CTES + "SELECT * FROM upserted")
def ledger_upsert_q(spark, sf_dir):
    return doc_ledger.upserted(spark, sf_dir)


@register("ledger_latest", oracle.LEDGER_CTES
          + "SELECT * FROM upserted ORDER BY finished_at DESC NULLS FIRST, file_md5 ASC LIMIT 5")
def ledger_latest_q(spark, sf_dir):
    return ledger.latest_runs(doc_ledger.upserted(spark, sf_dir), 5)


@register("ledger_invalid_status", oracle.LEDGER_CTES + """
SELECT * REPLACE (CASE WHEN total_rows % 7 = 0 THEN 'lost' ELSE status END AS status) FROM upserted
WHERE total_rows % 7 = 0 OR status NOT IN ('completed', 'skipped', 'failed')""")
def ledger_invalid_status_q(spark, sf_dir):
    """S8 on a ledger in which some rows have a status outside the domain."""
    dirty = doc_ledger.upserted(spark, sf_dir).withColumn(
        "status", F.when(F.col("total_rows") % 7 == 0, "lost").otherwise(F.col("status")))
    return ledger.invalid_status(dirty)


@register("events_open_run", oracle.LEDGER_CTES + """
, r AS (SELECT file_path, started_at, finished_at FROM prior)
SELECT event_id, file_path AS open_run FROM (
  SELECT e.event_id, r.file_path,
    row_number() OVER (PARTITION BY e.event_id ORDER BY r.started_at DESC NULLS LAST, r.file_path DESC) AS place
  FROM events e LEFT JOIN r ON r.started_at <= e.ts AND (r.finished_at IS NULL OR e.ts < r.finished_at)) WHERE place = 1""")
def events_open_run_q(spark, sf_dir):
    """Every event with the load that ran when it happened; a failed load has no end."""
    return asof.with_open_interval(
        read_table(spark, sf_dir, "events").select("event_id", "ts"), "ts", doc_ledger.prior_ledger(spark, sf_dir),
        "started_at", "finished_at", "file_path", "open_run").select("event_id", "open_run")


# --- star: R1–R11 ------------------------------------------------------------

@register("fact_job_posting", oracle.q(oracle.STAR_FACT))
def fact_job_posting_q(spark, sf_dir):
    return star.fact_from_staging(_staging(spark, sf_dir))


@register("fact_job_posting_daily", oracle.q(oracle.STAR_FACT_DAILY))
def fact_job_posting_daily_q(spark, sf_dir):
    return star.fact_job_posting_daily(dedup.with_business_key(_raw(spark, sf_dir)))


@register("nested_as_json", oracle.q("""
SELECT raw_job_id, to_json(skills_arr)::VARCHAR AS skills_json, type_json AS type_skills_json FROM stg"""))
def nested_as_json_q(spark, sf_dir):
    """The staged skills and the skills by category as JSON text."""
    return nested.nested_as_json(_staging(spark, sf_dir)).select(
        "raw_job_id", F.col("job_skills_array").alias("skills_json"), F.col("job_type_skills").alias("type_skills_json"))


@register("dim_date", oracle.q(oracle.STAR_DIM_DATE))
def dim_date_q(spark, sf_dir):
    return star.dim_date(_postings(spark, sf_dir)["job_posting"])


@register("dim_job_flags", oracle.q(oracle.STAR_DIM_FLAGS))
def dim_job_flags_q(spark, sf_dir):
    return star.dim_job_flags(_postings(spark, sf_dir)["job_posting"])


@register("skill_measures", oracle.q("""
SELECT job_id, count(*) AS skill_count, count(DISTINCT skill_id) AS distinct_skill_count
FROM job_skill GROUP BY job_id"""))
def skill_measures_q(spark, sf_dir):
    return star.skill_measures(_models(spark, sf_dir)["job_skill"])


@register("bridge_skill_weight", oracle.q("""
SELECT job_id, skill_id, 1.0 / count(*) OVER (PARTITION BY job_id) AS weight
FROM (SELECT DISTINCT job_id, skill_id FROM job_skill)"""))
def bridge_skill_weight_q(spark, sf_dir):
    return star.weights_from_staging(_staging(spark, sf_dir))


@register("jobs_per_month", oracle.q("""
SELECT c.company_name, k.month, k.job_count FROM (
  SELECT company_id, date_trunc('month', try_strptime(posted_date, '%Y-%m-%d %H:%M:%S')) AS month,
    count(*) AS job_count
  FROM job_posting GROUP BY 1, 2) k LEFT JOIN company c ON c.company_id = k.company_id"""))
def jobs_per_month_q(spark, sf_dir):
    m = _postings(spark, sf_dir)
    return star.jobs_per_month(m["job_posting"], m["company"])


@register("top_skills_by_title", oracle.q("""
SELECT t.job_title_short, r.skill_rank, r.skill_name, r.job_count FROM (
  SELECT title_cat_id, skill_name, job_count,
    CAST(row_number() OVER (PARTITION BY title_cat_id ORDER BY job_count DESC, skill_name ASC) AS INTEGER)
      AS skill_rank
  FROM (
    SELECT p.title_cat_id, s.skill_name, count(*) AS job_count
    FROM (SELECT DISTINCT job_id, skill_id FROM job_skill) b
    JOIN job_posting p ON p.job_id = b.job_id
    JOIN skill s ON s.skill_id = b.skill_id
    GROUP BY p.title_cat_id, s.skill_name)
) r LEFT JOIN job_title_category t ON t.title_cat_id = r.title_cat_id
WHERE r.skill_rank <= 5"""))
def top_skills_by_title_q(spark, sf_dir):
    return star.top_skills_from_staging(_staging(spark, sf_dir), 5)


@register("avg_salary_country_platform", oracle.q("""
SELECT c.country_name, pl.platform_name, k.job_count, k.avg_salary_year, k.min_salary_year, k.max_salary_year
FROM (
  SELECT country_id, platform_id, count(*) AS job_count,
    ((2 * sum(CAST(salary_year_avg * 100 AS BIGINT)) + count(salary_year_avg)) // (2 * count(salary_year_avg))) / 100.0
      AS avg_salary_year,
    min(salary_year_avg) AS min_salary_year, max(salary_year_avg) AS max_salary_year
  FROM job_posting WHERE salary_year_avg IS NOT NULL GROUP BY 1, 2
) k LEFT JOIN country c ON c.country_id = k.country_id
LEFT JOIN platform pl ON pl.platform_id = k.platform_id"""))
def avg_salary_country_platform_q(spark, sf_dir):
    m = _postings(spark, sf_dir)
    return star.avg_salary_country_platform(m["job_posting"], m["country"], m["platform"])


@register("remote_vs_onsite", oracle.q("""
SELECT CASE WHEN work_from_home IS NULL THEN 'unknown' WHEN work_from_home THEN 'remote' ELSE 'on-site' END
    AS remote_label,
  count(*) AS job_count,
  count(salary_year_avg) AS jobs_with_year_salary,
  CASE WHEN count(salary_year_avg) > 0 THEN
    ((2 * sum(CAST(salary_year_avg * 100 AS BIGINT)) + count(salary_year_avg)) // (2 * count(salary_year_avg))) / 100.0
  END AS avg_salary_year,
  count(salary_hour_avg) AS jobs_with_hour_salary,
  CASE WHEN count(salary_hour_avg) > 0 THEN
    ((2 * sum(CAST(salary_hour_avg * 100 AS BIGINT)) + count(salary_hour_avg)) // (2 * count(salary_hour_avg))) / 100.0
  END AS avg_salary_hour
FROM job_posting GROUP BY 1"""))
def remote_vs_onsite_q(spark, sf_dir):
    return star.remote_vs_onsite(_postings(spark, sf_dir)["job_posting"])


@register("posting_cube", oracle.q(oracle.STAR_CUBE))
def posting_cube_q(spark, sf_dir):
    return star.posting_cube(_postings(spark, sf_dir)["job_posting"])


@register("validity_intervals", oracle.q(oracle.STAR_VALIDITY))
def validity_intervals_q(spark, sf_dir):
    return star.validity_intervals(star.fact_job_posting_daily(dedup.with_business_key(_raw(spark, sf_dir))))


@register("moving_volume", oracle.q(oracle.STAR_MOVING))
def moving_volume_q(spark, sf_dir):
    return star.moving_volume(_postings(spark, sf_dir)["job_posting"])


__all__ = ["REGISTRY", "register"]
