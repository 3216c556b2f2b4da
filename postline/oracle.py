"""DuckDB SQL twins of the registered queries (the correctness oracle).

The base CTEs rebuild, independently of the Spark code, the postings source
derived from the driver tables, the typed landing rows, and every model from one
grouping of the landing rows by business key (earliest row, sorted sets of
skills and of category and skill pairs).  Nested values are carried
as lists; outputs flatten them to text (``|`` between list items, ``k:a,b;``
for maps with sorted keys).
"""

from __future__ import annotations

RUN_TS_SQL = "TIMESTAMP '2025-01-01 00:00:00'"

_NA = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
       "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")


def _null_like(x: str) -> str:
    return f"({x} IS NULL OR {x} IN ({_NA}) OR lower(trim({x})) IN ('', 'null', 'none', 'nan'))"


def _text(x: str) -> str:
    return f"CASE WHEN {_null_like(x)} THEN NULL ELSE trim({x}) END"


def _bool(x: str) -> str:
    return (f"CASE WHEN {_null_like(x)} THEN NULL "
            f"WHEN lower(trim({x})) IN ('true', 't', '1', 'yes', 'y') THEN true "
            f"WHEN lower(trim({x})) IN ('false', 'f', '0', 'no', 'n') THEN false END")


def _dec(x: str, p: int) -> str:
    return f"CASE WHEN {_null_like(x)} THEN NULL ELSE TRY_CAST(trim({x}) AS DECIMAL({p},2)) END"


def _canon(x: str) -> str:
    return f"nullif(lower(trim({x})), '')"


_KEY_TEXT = ["company_name", "job_title", "job_location", "job_posted_date", "job_schedule_type", "job_via"]
_KEY_VALUE = ["salary_year_avg", "salary_hour_avg", "job_work_from_home", "job_no_degree_mention",
              "job_health_insurance"]
_KEY_TAIL = ["job_country", "salary_rate"]
_BK = "md5(concat_ws('||', " + ", ".join(
    [f"coalesce(lower(trim({c})), '')" for c in _KEY_TEXT]
    + [f"coalesce(CAST({c} AS VARCHAR), '')" for c in _KEY_VALUE]
    + [f"coalesce(lower(trim({c})), '')" for c in _KEY_TAIL]) + "))"

POSTING_COLS = ("job_title_short, job_title, job_location, job_via, job_schedule_type, job_work_from_home, "
                "search_location, job_posted_date, job_no_degree_mention, job_health_insurance, job_country, "
                "salary_rate, salary_year_avg, salary_hour_avg, company_name")

def _sorted_set(items: str) -> str:
    return f"list_sort(list_distinct({items}))"


# Over the rows of a group: the trimmed skills, and the trimmed (category, skill) pairs, without blank ones.
_SKILLS = ("list_filter(list_transform(flatten(list(coalesce(skills_list, []))), lambda s: trim(s)), "
           "lambda s: s <> '')")
_PAIRS = ("list_filter(flatten(list(flatten(list_transform(coalesce(type_entries, []), lambda e: "
          "list_transform(e.value, lambda s: {'category': trim(e.key), 'skill': trim(s)}))))), "
          "lambda p: p.category <> '' AND p.skill <> '')")

# dimension -> (source: a relation and its column, id, name)
_DIMENSIONS = {
    "company": ("merged", "f.company_name", "company_id", "company_name"),
    "country": ("merged", "f.job_country", "country_id", "country_name"),
    "platform": ("merged", "f.job_via", "platform_id", "platform_name"),
    "schedule_type": ("merged", "f.job_schedule_type", "schedule_type_id", "schedule_name"),
    "salary_rate_type": ("merged", "f.salary_rate", "rate_type_id", "rate_name"),
    "job_title_category": ("merged", "f.job_title_short", "title_cat_id", "job_title_short"),
    "skill": ("(SELECT skill_name FROM flat UNION ALL SELECT skill_name FROM grouped)", "skill_name", "skill_id",
              "skill_name"),
    "skill_category": ("grouped", "skill_category", "skill_cat_id", "category_name"),
}
_POSTING_FIELDS = ("job_title_short, job_title AS job_title_full, job_location, search_location, "
                   "job_posted_date AS posted_date, job_work_from_home AS work_from_home, "
                   "job_no_degree_mention AS no_degree_mention, job_health_insurance AS health_insurance, "
                   "salary_year_avg, salary_hour_avg")


def _fields(columns: str) -> str:
    """Fields of the first row ``f``, renamed as said."""
    named = [c.strip().split(" AS ") for c in columns.split(",")]
    return ", ".join(f"f.{c[0]} AS {c[-1]}" for c in named)


def _dimensions() -> str:
    return ",\n".join(
        f"{name} AS (SELECT DISTINCT md5({_canon(col)}) AS {key}, {_canon(col)} AS {label}, {RUN_TS_SQL} AS created_at "
        f"FROM {rel} WHERE {_canon(col)} IS NOT NULL)"
        for name, (rel, col, key, label) in _DIMENSIONS.items())


def _keys() -> str:
    return ", ".join(f"md5({_canon(col)}) AS {key}" for rel, col, key, _ in _DIMENSIONS.values() if rel == "merged")


BASE = f"""
WITH lines AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_partkey AS pk, p.p_name, p.p_type, p.p_brand
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
per_order AS (
  SELECT k,
    string_agg('''' || p_name || '''', ', ' ORDER BY ln, pk) AS names_lit,
    string_agg('''' || p_brand || '''', ' ,' ORDER BY ln, pk) AS brands_lit,
    list(p_name ORDER BY ln, pk) AS names_list,
    list(p_brand ORDER BY ln, pk) AS brands_list,
    first(p_name ORDER BY ln, pk) AS first_name
  FROM lines GROUP BY k
),
per_type AS (
  SELECT k, p_type,
    string_agg('''' || p_name || '''', ', ' ORDER BY ln, pk) AS names_lit,
    string_agg('''' || p_brand || '''', ',' ORDER BY ln, pk) AS brands_lit,
    list(p_name ORDER BY ln, pk) AS names_list,
    list(p_brand ORDER BY ln, pk) AS brands_list,
    first(p_name ORDER BY ln, pk) AS first_name
  FROM lines GROUP BY k, p_type
),
type_lits AS (
  SELECT k,
    string_agg('''' || p_type || ''': [' || names_lit || ']', ', ' ORDER BY p_type) AS d0,
    string_agg('''' || lower(p_type) || ''':[' || brands_lit || ']', ', ' ORDER BY p_type) AS d1,
    first('''' || p_type || ''': ''' || first_name || '''' ORDER BY p_type) AS scalar0,
    list({{'key': p_type, 'value': names_list}} ORDER BY p_type) AS entries0,
    list({{'key': lower(p_type), 'value': brands_list}} ORDER BY p_type) AS entries1,
    first([{{'key': p_type, 'value': [first_name]}}] ORDER BY p_type) AS entries_scalar
  FROM per_type GROUP BY k
),
base AS (
  SELECT o.o_orderkey AS k, unnest(CASE WHEN o.o_orderkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS copy,
    o.o_orderstatus AS status, o.o_orderpriority AS prio, o.o_totalprice AS price, o.o_orderdate AS odate,
    c.c_mktsegment AS seg, c.c_name AS cname, n.n_name AS nat,
    po.names_lit, po.brands_lit, po.names_list, po.brands_list, po.first_name,
    tl.d0, tl.d1, tl.scalar0, tl.entries0, tl.entries1, tl.entries_scalar
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN per_order po ON po.k = o.o_orderkey
  LEFT JOIN type_lits tl ON tl.k = o.o_orderkey
),
cells AS (
  SELECT k, copy, k * 2 + copy AS source_row, CAST((k + 3 * copy) % 4 AS INTEGER) AS batch,
    CASE WHEN copy = 1 THEN lower(seg) WHEN k % 23 = 0 THEN '   ' ELSE seg END AS job_title_short,
    CASE WHEN copy = 1 THEN '  ' || upper(seg || ' Analyst ' || substring(prio, 3, 1000)) || ' '
         ELSE seg || ' Analyst ' || substring(prio, 3, 1000) END AS job_title,
    CASE WHEN copy = 1 THEN lower(nat) ELSE nat END AS job_location,
    CASE WHEN k % 11 = 0 THEN (CASE WHEN copy = 1 THEN ' ' ELSE '' END)
         WHEN copy = 1 THEN 'PLATFORM ' || CAST(k % 7 AS VARCHAR)
         ELSE 'Platform ' || CAST(k % 7 AS VARCHAR) END AS job_via,
    prio AS job_schedule_type,
    CASE WHEN status = 'O' THEN (CASE WHEN copy = 1 THEN 'yes' ELSE 'True' END)
         WHEN status = 'F' THEN (CASE WHEN copy = 1 THEN 'n' ELSE 'False' END)
         ELSE (CASE WHEN copy = 1 THEN '' ELSE 'unknown' END) END AS job_work_from_home,
    CASE WHEN copy = 1 THEN 'Anywhere' ELSE nat END AS search_location,
    CASE WHEN copy = 1 THEN ' ' || strftime(odate, '%Y-%m-%d %H:%M:%S') || ' '
         ELSE strftime(odate, '%Y-%m-%d %H:%M:%S') END AS job_posted_date,
    CASE WHEN k % 2 = 0 THEN (CASE WHEN copy = 1 THEN 't' ELSE '1' END)
         ELSE (CASE WHEN copy = 1 THEN 'f' ELSE '0' END) END AS job_no_degree_mention,
    CASE WHEN k % 17 = 0 THEN 'N/A'
         WHEN prio IN ('1-URGENT', '2-HIGH') THEN (CASE WHEN copy = 1 THEN 'TRUE' ELSE 'Y' END)
         ELSE (CASE WHEN copy = 1 THEN 'FALSE' ELSE 'N' END) END AS job_health_insurance,
    CASE WHEN copy = 1 THEN '  ' || nat ELSE nat END AS job_country,
    CASE WHEN k % 3 = 0 THEN (CASE WHEN copy = 1 THEN 'YEAR ' ELSE 'year' END)
         WHEN k % 3 = 1 THEN (CASE WHEN copy = 1 THEN 'Hour' ELSE 'hour' END)
         ELSE '' END AS salary_rate,
    CASE WHEN k % 3 <> 0 THEN '' WHEN k % 19 = 0 THEN '12,5 k'
         WHEN copy = 1 THEN ' ' || CAST(CAST(price AS DECIMAL(12,2)) AS VARCHAR) || '0'
         ELSE CAST(CAST(price AS DECIMAL(12,2)) AS VARCHAR) END AS salary_year_avg,
    CASE WHEN k % 3 = 1 THEN CAST(k % 90 + 10 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0')
                             || (CASE WHEN copy = 1 THEN '0' ELSE '' END)
         ELSE '' END AS salary_hour_avg,
    CASE WHEN k % 97 = 0 THEN '' WHEN copy = 1 THEN '  ' || upper(cname) ELSE cname END AS company_name,
    CASE WHEN names_list IS NULL THEN NULL
         WHEN copy = 1 THEN '[ ' || brands_lit || (CASE WHEN k % 10 = 0 THEN ' ,''' || upper(first_name) || '''' ELSE '' END) || ' ]'
         WHEN k % 13 = 0 THEN '[broken, list'
         WHEN k % 29 = 0 THEN '[]'
         WHEN k % 31 = 0 THEN '[' || names_lit || ', ''  '', None, ''null'']'
         WHEN k % 37 = 0 THEN '["' || first_name || '''s", ' || names_lit || ']'
         ELSE '[' || names_lit || ']' END AS job_skills,
    CASE WHEN names_list IS NULL THEN NULL
         WHEN copy = 1 THEN '{{' || d1 || '}}'
         WHEN k % 13 = 0 THEN '{{no dict'
         WHEN k % 29 = 0 THEN '{{}}'
         WHEN k % 31 = 0 THEN '{{' || d0 || ', '' '': [''x''], ''EMPTY'': []}}'
         WHEN k % 41 = 0 THEN '{{' || scalar0 || '}}'
         ELSE '{{' || d0 || '}}' END AS job_type_skills,
    -- what a correct literal reader + cleaner must recover
    CASE WHEN names_list IS NULL THEN NULL
         WHEN copy = 1 THEN (CASE WHEN k % 10 = 0 THEN list_append(brands_list, upper(first_name)) ELSE brands_list END)
         WHEN k % 13 = 0 OR k % 29 = 0 THEN NULL
         WHEN k % 31 = 0 THEN names_list
         WHEN k % 37 = 0 THEN list_prepend(first_name || '''s', names_list)
         ELSE names_list END AS skills_list,
    CASE WHEN names_list IS NULL THEN NULL
         WHEN copy = 1 THEN entries1
         WHEN k % 13 = 0 OR k % 29 = 0 THEN NULL
         WHEN k % 31 = 0 THEN entries0
         WHEN k % 41 = 0 THEN entries_scalar
         ELSE entries0 END AS type_entries
  FROM base
),
landing AS (
  SELECT source_row AS id,
    {_text('job_title_short')} AS job_title_short,
    {_text('job_title')} AS job_title,
    {_text('job_location')} AS job_location,
    {_text('job_via')} AS job_via,
    {_text('job_schedule_type')} AS job_schedule_type,
    {_bool('job_work_from_home')} AS job_work_from_home,
    {_text('search_location')} AS search_location,
    {_text('job_posted_date')} AS job_posted_date,
    {_bool('job_no_degree_mention')} AS job_no_degree_mention,
    {_bool('job_health_insurance')} AS job_health_insurance,
    {_text('job_country')} AS job_country,
    {_text('salary_rate')} AS salary_rate,
    {_dec('salary_year_avg', 12)} AS salary_year_avg,
    {_dec('salary_hour_avg', 8)} AS salary_hour_avg,
    {_text('company_name')} AS company_name,
    skills_list, type_entries,
    {_null_like('job_skills')} AS job_skills_missing,
    (NOT {_null_like('job_skills')}) AND skills_list IS NULL AS job_skills_invalid,
    {_null_like('job_type_skills')} AS job_type_skills_missing,
    (NOT {_null_like('job_type_skills')}) AND type_entries IS NULL AS job_type_skills_invalid,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(batch * 18) AS ingested_at, batch
  FROM cells
),
keyed AS (
  SELECT *, id AS raw_job_id, {_BK} AS business_key FROM landing
),
-- all rows of a key at once: its earliest row, and what the literals of all its rows hold
merged AS (
  SELECT business_key, first(r ORDER BY ingested_at ASC NULLS LAST, raw_job_id ASC) AS f,
    {_sorted_set(_SKILLS)} AS skills,
    {_sorted_set(_PAIRS)} AS pairs
  FROM keyed AS r GROUP BY business_key
),
prim AS (SELECT business_key, f.raw_job_id AS raw_job_id, f.ingested_at AS ingested_at FROM merged),
skill_sets AS (SELECT business_key, skills FROM merged WHERE len(skills) > 0),
type_sets AS (
  SELECT business_key, p.category AS category, list(p.skill ORDER BY p.skill) AS skills
  FROM (SELECT business_key, unnest(pairs) AS p FROM merged) GROUP BY ALL
),
stg AS (
  SELECT f.raw_job_id AS raw_job_id, business_key, {_fields(POSTING_COLS)}, skills AS skills_arr,
    array_to_string(list_transform(list_sort(list_distinct(list_transform(pairs, lambda p: p.category))), lambda c:
      c || ':' || array_to_string(list_transform(list_filter(pairs, lambda p: p.category = c), lambda p: p.skill), ',')),
      ';') AS type_text,
    '{{' || array_to_string(list_transform(list_sort(list_distinct(list_transform(pairs, lambda p: p.category))), lambda c:
      to_json(c)::VARCHAR || ':' || to_json(list_transform(list_filter(pairs, lambda p: p.category = c), lambda p: p.skill))::VARCHAR),
      ',') || '}}' AS type_json,
    f.ingested_at AS ingested_at, {RUN_TS_SQL} AS processed_at
  FROM merged
),
flat AS (
  SELECT md5(f.raw_job_id::VARCHAR || '||' || name) AS skill_assignment_id, f.raw_job_id AS raw_job_id, business_key,
    name AS skill_name, f.ingested_at AS ingested_at
  FROM (SELECT business_key, f, lower(trim(unnest(skills))) AS name FROM merged) WHERE name <> ''
),
grouped AS (
  SELECT md5(f.raw_job_id::VARCHAR || '||' || cat || '||' || name) AS grouped_skill_assignment_id,
    f.raw_job_id AS raw_job_id, business_key, name AS skill_name, cat AS skill_category, f.ingested_at AS ingested_at
  FROM (SELECT business_key, f, lower(trim(p.category)) AS cat, lower(trim(p.skill)) AS name
        FROM (SELECT business_key, f, unnest(pairs) AS p FROM merged))
  WHERE cat <> '' AND name <> ''
),
{_dimensions()},
job_posting AS (
  SELECT md5(business_key) AS job_id, business_key, f.raw_job_id AS raw_job_id, {_fields(_POSTING_FIELDS)},
    {_keys()}, f.ingested_at AS ingested_at, {RUN_TS_SQL} AS created_at
  FROM merged WHERE trim(coalesce(f.company_name, '')) <> ''
),
job_skill AS (
  SELECT md5(business_key) AS job_id, link.skill AS skill_id, link.cat AS skill_cat_id, f.ingested_at AS ingested_at,
    {RUN_TS_SQL} AS created_at
  FROM (
    SELECT business_key, f, unnest(list_distinct(list_concat(
      list_transform(skills, lambda s: {{'skill': md5(lower(trim(s))), 'cat': NULL::VARCHAR}}),
      list_transform(pairs, lambda p: {{'skill': md5(lower(trim(p.skill))), 'cat': md5(lower(trim(p.category)))}})))) AS link
    FROM merged WHERE trim(coalesce(f.company_name, '')) <> '')
)
"""


def q(body: str) -> str:
    return BASE + body


# relation name in the models → CTE name above
_REL = {"stg_raw_jobs": "stg", "stg_job_skills_exploded": "flat", "stg_job_type_skills_exploded": "grouped"}


def _check_sql(ch) -> str:
    rel = _REL.get(ch.relation, ch.relation)
    head = f"SELECT '{ch.name}' AS check_name, '{ch.relation}' AS relation, '{ch.kind}' AS kind, "
    if ch.kind == "not_null":
        return head + f"count(*) AS failures FROM {rel} WHERE {ch.columns[0]} IS NULL"
    if ch.kind == "unique":
        c = ch.columns[0]
        return head + (f"count(*) AS failures FROM (SELECT {c} FROM {rel} WHERE {c} IS NOT NULL "
                       f"GROUP BY {c} HAVING count(*) > 1)")
    if ch.kind == "relationships":
        c, parent, pf = ch.columns[0], _REL.get(ch.parent, ch.parent), ch.parent_field
        extra = f" AND ({ch.where})" if ch.where else ""
        return head + (f"CAST(coalesce(sum(n), 0) AS BIGINT) AS failures FROM (SELECT {c} AS k, count(*) AS n "
                       f"FROM {rel} WHERE {c} IS NOT NULL{extra} GROUP BY {c}) x "
                       f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pf} = x.k)")
    if ch.kind == "composite_key_unique":
        cols = ", ".join(ch.columns)
        return head + f"count(*) AS failures FROM (SELECT {cols} FROM {rel} GROUP BY {cols} HAVING count(*) > 1)"
    if ch.kind == "dates_not_future":
        c = ch.columns[0]
        return head + (f"count(*) AS failures FROM (SELECT count(*) FROM {rel} WHERE {c} IS NOT NULL "
                       f"AND {c} > CAST(current_timestamp AS TIMESTAMP) HAVING count(*) > 0)")
    if ch.name == "job_posting_matches_staging":
        return head + ("count(*) AS failures FROM stg WHERE trim(coalesce(company_name, '')) <> '' "
                       "AND business_key NOT IN (SELECT business_key FROM job_posting)")
    if ch.name == "job_skill_unique_combination":
        return head + ("count(*) AS failures FROM (SELECT job_id, skill_id, skill_cat_id FROM job_skill "
                       "GROUP BY job_id, skill_id, skill_cat_id HAVING count(*) > 1)")
    raise ValueError(ch.name)


def quality_report_sql(checks) -> str:
    return BASE + "\nUNION ALL\n".join(_check_sql(ch) for ch in checks)


_LINES = "CAST(len(string_split(text, chr(10))) AS BIGINT)"
_PATH = "'documents/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt'"

LEDGER_CTES = f"""
WITH files AS (
  SELECT {_PATH} AS file_path, md5(text) AS file_md5, source AS source_name, {_LINES} AS total_rows
  FROM documents
),
prior_rows AS (
  SELECT md5(d.text) AS file_md5, d.doc_id, {_PATH.replace("source", "d.source").replace("CAST(doc_id", "CAST(d.doc_id")} AS file_path, d.source AS source_name,
    CASE WHEN l.quality = 1 THEN 'completed' ELSE 'failed' END AS status, {_LINES.replace("text", "d.text")} AS lines,
    row_number() OVER (PARTITION BY md5(d.text) ORDER BY d.doc_id) AS rn
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id
),
prior AS (
  SELECT file_md5, file_path, source_name, status,
    lines AS total_rows, CAST(CASE WHEN status = 'completed' THEN lines ELSE 0 END AS BIGINT) AS inserted_rows,
    CAST(0 AS BIGINT) AS parse_warnings, CAST(0 AS BIGINT) AS job_skills_missing,
    CAST(0 AS BIGINT) AS job_skills_invalid, CAST(0 AS BIGINT) AS job_type_skills_missing,
    CAST(0 AS BIGINT) AS job_type_skills_invalid,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS started_at,
    CASE WHEN status = 'completed' THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) + to_seconds(30) END
      AS finished_at
  FROM prior_rows WHERE rn = 1
),
one_per_hash AS (
  SELECT file_md5, file_path, source_name, total_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY file_md5 ORDER BY file_path) AS rn FROM files) WHERE rn = 1
),
pending AS (
  SELECT * FROM one_per_hash o
  WHERE NOT EXISTS (SELECT 1 FROM prior p WHERE p.file_md5 = o.file_md5 AND p.status = 'completed')
),
entries AS (
  SELECT file_md5, file_path, source_name, 'completed' AS status,
    total_rows, total_rows AS inserted_rows, CAST(0 AS BIGINT) AS parse_warnings,
    CAST(0 AS BIGINT) AS job_skills_missing, CAST(0 AS BIGINT) AS job_skills_invalid,
    CAST(0 AS BIGINT) AS job_type_skills_missing, CAST(0 AS BIGINT) AS job_type_skills_invalid,
    {RUN_TS_SQL} AS started_at, {RUN_TS_SQL} AS finished_at
  FROM pending
),
upserted AS (
  SELECT coalesce(o.file_md5, n.file_md5) AS file_md5,
    coalesce(o.file_path, n.file_path) AS file_path,
    coalesce(o.source_name, n.source_name) AS source_name,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.status ELSE o.status END AS status,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.total_rows ELSE o.total_rows END AS total_rows,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.inserted_rows ELSE o.inserted_rows END AS inserted_rows,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.parse_warnings ELSE o.parse_warnings END AS parse_warnings,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.job_skills_missing ELSE o.job_skills_missing END AS job_skills_missing,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.job_skills_invalid ELSE o.job_skills_invalid END AS job_skills_invalid,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.job_type_skills_missing ELSE o.job_type_skills_missing END
      AS job_type_skills_missing,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.job_type_skills_invalid ELSE o.job_type_skills_invalid END
      AS job_type_skills_invalid,
    coalesce(o.started_at, n.started_at) AS started_at,
    CASE WHEN n.file_md5 IS NOT NULL THEN n.finished_at ELSE o.finished_at END AS finished_at
  FROM prior o FULL OUTER JOIN entries n ON o.file_md5 = n.file_md5
)
"""

_POSTED = "try_strptime(posted_date, '%Y-%m-%d %H:%M:%S')"
_FLAG_KEY = ("CAST((CASE WHEN work_from_home IS NULL THEN 2 WHEN work_from_home THEN 1 ELSE 0 END)"
             " + 3 * (CASE WHEN no_degree_mention IS NULL THEN 2 WHEN no_degree_mention THEN 1 ELSE 0 END)"
             " + 9 * (CASE WHEN health_insurance IS NULL THEN 2 WHEN health_insurance THEN 1 ELSE 0 END) AS INTEGER)")

STAR_FACT = f"""
SELECT p.job_id, p.company_id, p.country_id, p.platform_id, p.schedule_type_id, p.rate_type_id, p.title_cat_id,
  CAST(year({_POSTED}) * 10000 + month({_POSTED}) * 100 + day({_POSTED}) AS INTEGER) AS date_key,
  {_FLAG_KEY} AS job_flags_key, 1 AS job_count, p.salary_year_avg, p.salary_hour_avg,
  coalesce(m.skill_count, 0) AS skill_count, coalesce(m.distinct_skill_count, 0) AS distinct_skill_count
FROM job_posting p LEFT JOIN (
  SELECT job_id, count(*) AS skill_count, count(DISTINCT skill_id) AS distinct_skill_count
  FROM job_skill GROUP BY job_id) m ON m.job_id = p.job_id"""

STAR_FACT_DAILY = f"""
SELECT md5(business_key) AS job_id,
  CAST(year(day) * 10000 + month(day) * 100 + day(day) AS INTEGER) AS ingestion_date_key, day AS ingestion_date,
  {_keys()},
  CAST(year(posted) * 10000 + month(posted) * 100 + day(posted) AS INTEGER) AS date_key, {_FLAG_KEY} AS job_flags_key,
  f.salary_year_avg AS salary_year_avg, f.salary_hour_avg AS salary_hour_avg, records_seen
FROM (
  SELECT *, f.job_work_from_home AS work_from_home, f.job_no_degree_mention AS no_degree_mention,
    f.job_health_insurance AS health_insurance, try_strptime(f.job_posted_date, '%Y-%m-%d %H:%M:%S') AS posted
  FROM (
    SELECT business_key, CAST(ingested_at AS DATE) AS day, count(*) AS records_seen,
      first(r ORDER BY ingested_at, raw_job_id) AS f
    FROM keyed AS r WHERE trim(coalesce(company_name, '')) <> '' GROUP BY ALL))"""

_RECORD = ("company_id, country_id, platform_id, schedule_type_id, rate_type_id, title_cat_id, date_key, job_flags_key, "
           "salary_year_avg, salary_hour_avg")

STAR_VALIDITY = f"""
SELECT job_id, span_no, {_RECORD}, valid_from,
  CAST(lead(valid_from) OVER (PARTITION BY job_id ORDER BY span_no) - INTERVAL 1 DAY AS DATE) AS valid_to, days_seen, records_seen
FROM (
  SELECT job_id, span_no, {_RECORD}, min(ingestion_date) AS valid_from, count(*) AS days_seen,
    CAST(sum(records_seen) AS BIGINT) AS records_seen
  FROM (SELECT *, CAST(sum(CASE WHEN place = 1 OR NOT (row({_RECORD}) IS NOT DISTINCT FROM before) THEN 1 ELSE 0 END)
      OVER (PARTITION BY job_id ORDER BY ingestion_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS span_no
    FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ingestion_date) AS place,
        lag(row({_RECORD})) OVER (PARTITION BY job_id ORDER BY ingestion_date) AS before
      FROM ({STAR_FACT_DAILY})))
  GROUP BY ALL)"""

_CENTS = "CAST(salary_year_avg * 100 AS BIGINT)"
_MEAN = f"((2 * sum({_CENTS}) + count(salary_year_avg)) // (2 * count(salary_year_avg))) / 100.0"

STAR_CUBE = f"""
SELECT CAST(grouping(month) * 8 + grouping(company_id) * 4 + grouping(country_id) * 2 + grouping(platform_id) AS BIGINT) AS grouping,
  month, company_id, country_id, platform_id, count(*) AS job_count, count(salary_year_avg) AS jobs_with_year_salary,
  CASE WHEN count(salary_year_avg) > 0 THEN {_MEAN} END AS avg_salary_year
FROM (SELECT *, date_trunc('month', {_POSTED}) AS month FROM job_posting)
GROUP BY GROUPING SETS ((month, company_id), (month, country_id), (month, platform_id), (country_id, platform_id), (month), (company_id), ())"""

STAR_MOVING = f"""
SELECT company_id, posting_date, jobs, CAST(sum(jobs) OVER w AS BIGINT) AS jobs_moving, CAST(sum(paid) OVER w AS BIGINT) AS paid_moving,
  CASE WHEN sum(paid) OVER w > 0 THEN ((2 * sum(cents) OVER w + sum(paid) OVER w) // (2 * sum(paid) OVER w)) / 100.0 END AS avg_salary_moving
FROM (SELECT company_id, CAST({_POSTED} AS DATE) AS posting_date, count(*) AS jobs, count(salary_year_avg) AS paid,
    coalesce(sum({_CENTS}), 0) AS cents
  FROM job_posting WHERE {_POSTED} IS NOT NULL GROUP BY 1, 2)
WINDOW w AS (PARTITION BY company_id ORDER BY posting_date RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW)"""

STAR_DIM_DATE = f"""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS iso_day_of_week, monthname(d) AS month_name
FROM (SELECT DISTINCT CAST({_POSTED} AS DATE) AS d FROM job_posting) WHERE d IS NOT NULL"""

STAR_DIM_FLAGS = f"""
SELECT {_FLAG_KEY} AS job_flags_key, work_from_home, no_degree_mention, health_insurance,
  CASE WHEN work_from_home IS NULL THEN 'unknown' WHEN work_from_home THEN 'remote' ELSE 'on-site' END AS remote_label,
  CASE WHEN no_degree_mention IS NULL THEN 'unknown' WHEN no_degree_mention THEN 'no degree mentioned'
       ELSE 'degree mentioned' END AS degree_label,
  CASE WHEN health_insurance IS NULL THEN 'unknown' WHEN health_insurance THEN 'health insurance'
       ELSE 'no health insurance' END AS benefits_label
FROM (SELECT DISTINCT work_from_home, no_degree_mention, health_insurance FROM job_posting)"""
