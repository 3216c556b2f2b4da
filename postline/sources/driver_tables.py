"""Postings-shaped source rows derived from the TPC-H-like driver tables.

The engine's input is a file of raw, dirty posting cells.  The driver ships
no such file, so this module derives one, deterministically, from
``orders ⋈ customer ⋈ nation`` (one posting per order) and
``lineitem ⋈ part`` (skills = the part names of the order's lines, grouped by
part type).  Orders whose key is a multiple of 5 appear a second time as a
re-scraped copy: same posting after normalisation, different spelling and a
different skill list, so deduplication has to merge them.

Every cell is text, exactly what a CSV reader would hand over.  Dirt is
injected by key rules (blank and NA cells, bad numbers, unknown booleans,
broken and empty literals, blank items, scalar dict values…).

Work grows with the tables: one shuffle groups lines by order, one join
attaches them to the orders; customer and nation are joined on their keys
(AQE broadcasts them only when measured small).  Cells are written as SQL
expression text: one parse per column when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.schemas import SOURCE_COLUMNS

# Fixed values of the derivation (the SQL twin in postline/oracle.py uses the same).
BASE_INGEST = "2024-01-01 00:00:00"   # load time of batch 0
BATCH_HOURS = 18                      # batches are 18 hours apart: four span three days
N_BATCHES = 4


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its lines (sorted) and the part types present."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    lines = li.join(part, li.l_partkey == part.p_partkey)
    return lines.groupBy("l_orderkey").agg(
        F.expr("sort_array(collect_list(struct(l_linenumber, l_partkey, p_name, p_type, p_brand))) AS lines")
    ).selectExpr("l_orderkey", "lines", "array_sort(array_distinct(transform(lines, x -> x.p_type))) AS types")


# --- SQL text of the cells ---------------------------------------------------

QUOTE = "'\\''"      # SQL literal holding one single quote


def lit(text: str) -> str:
    """SQL literal of plain text (escapes quotes and backslashes)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(expr: str) -> str:
    return f"concat({QUOTE}, {expr}, {QUOTE})"


def items(field: str, sep: str) -> str:
    return f"array_join(transform(lines, x -> {quoted('x.' + field)}), {lit(sep)})"


def dict_body(field: str, key: str, item_sep: str, value_open: str) -> str:
    members = "filter(lines, x -> x.p_type = t)"
    return (f"array_join(transform(types, t -> concat({quoted(key)}, {lit(value_open)}, "
            f"array_join(transform({members}, x -> {quoted('x.' + field)}), {lit(item_sep)}), ']')), ', ')")


def pick(v0: str, v1: str) -> str:
    return f"CASE WHEN copy = 1 THEN {v1} ELSE {v0} END"


K = "o_orderkey"
TITLE = "concat(c_mktsegment, ' Analyst ', substring(o_orderpriority, 3, 1000))"
YEAR = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)"
HOUR = f"concat(CAST({K} % 90 + 10 AS STRING), '.', lpad(CAST({K} % 100 AS STRING), 2, '0'))"
POSTED = "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
NAMES = items("p_name", ", ")
FIRST_NAME = "element_at(lines, 1).p_name"

SKILLS0 = (
    f"CASE WHEN {K} % 13 = 0 THEN '[broken, list' "
    f"WHEN {K} % 29 = 0 THEN '[]' "
    f"WHEN {K} % 31 = 0 THEN concat('[', {NAMES}, {lit(", '  ', None, 'null']")}) "
    f"WHEN {K} % 37 = 0 THEN concat('[\"', {FIRST_NAME}, {lit("'s" + '", ')}, {NAMES}, ']') "
    f"ELSE concat('[', {NAMES}, ']') END"
)
SKILLS1 = (
    f"concat('[ ', array_join(concat(transform(lines, x -> {quoted('x.p_brand')}), "
    f"CASE WHEN {K} % 10 = 0 THEN array({quoted('upper(' + FIRST_NAME + ')')}) "
    f"ELSE CAST(array() AS ARRAY<STRING>) END), ' ,'), ' ]')"
)
DICT0_BODY = dict_body("p_name", "t", ", ", ": [")
SCALAR0 = (f"concat('{{', {quoted('element_at(types, 1)')}, ': ', "
           f"{quoted('filter(lines, x -> x.p_type = element_at(types, 1))[0].p_name')}, '}}')")
DICT0 = (
    f"CASE WHEN {K} % 13 = 0 THEN '{{no dict' "
    f"WHEN {K} % 29 = 0 THEN '{{}}' "
    f"WHEN {K} % 31 = 0 THEN concat('{{', {DICT0_BODY}, {lit(", ' ': ['x'], 'EMPTY': []}")}) "
    f"WHEN {K} % 41 = 0 THEN {SCALAR0} "
    f"ELSE concat('{{', {DICT0_BODY}, '}}') END"
)
DICT1 = f"concat('{{', {dict_body('p_brand', 'lower(t)', ',', ':[')}, '}}')"

CELLS_SQL = {
    "job_title_short": pick(f"CASE WHEN {K} % 23 = 0 THEN '   ' ELSE c_mktsegment END", "lower(c_mktsegment)"),
    "job_title": pick(TITLE, f"concat('  ', upper({TITLE}), ' ')"),
    "job_location": pick("n_name", "lower(n_name)"),
    "job_via": (f"CASE WHEN {K} % 11 = 0 THEN {pick(lit(''), lit(' '))} "
                f"ELSE {pick(f'concat({lit('Platform ')}, CAST({K} % 7 AS STRING))', f'concat({lit('PLATFORM ')}, CAST({K} % 7 AS STRING))')} END"),
    "job_schedule_type": "o_orderpriority",
    "job_work_from_home": (f"CASE WHEN o_orderstatus = 'O' THEN {pick(lit('True'), lit('yes'))} "
                           f"WHEN o_orderstatus = 'F' THEN {pick(lit('False'), lit('n'))} "
                           f"ELSE {pick(lit('unknown'), lit(''))} END"),
    "search_location": pick("n_name", lit("Anywhere")),
    "job_posted_date": pick(POSTED, f"concat(' ', {POSTED}, ' ')"),
    "job_no_degree_mention": (f"CASE WHEN {K} % 2 = 0 THEN {pick(lit('1'), lit('t'))} "
                              f"ELSE {pick(lit('0'), lit('f'))} END"),
    "job_health_insurance": (f"CASE WHEN {K} % 17 = 0 THEN 'N/A' "
                             f"WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {pick(lit('Y'), lit('TRUE'))} "
                             f"ELSE {pick(lit('N'), lit('FALSE'))} END"),
    "job_country": pick("n_name", "concat('  ', n_name)"),
    "salary_rate": (f"CASE WHEN {K} % 3 = 0 THEN {pick(lit('year'), lit('YEAR '))} "
                    f"WHEN {K} % 3 = 1 THEN {pick(lit('hour'), lit('Hour'))} ELSE '' END"),
    "salary_year_avg": (f"CASE WHEN {K} % 3 <> 0 THEN '' WHEN {K} % 19 = 0 THEN '12,5 k' "
                        f"ELSE {pick(YEAR, f'concat(' + lit(' ') + f', {YEAR}, ' + lit('0') + ')')} END"),
    "salary_hour_avg": f"CASE WHEN {K} % 3 = 1 THEN {pick(HOUR, f'concat({HOUR}, ' + lit('0') + ')')} ELSE '' END",
    "company_name": f"CASE WHEN {K} % 97 = 0 THEN '' ELSE {pick('c_name', 'concat(' + lit('  ') + ', upper(c_name))')} END",
    "job_skills": f"CASE WHEN lines IS NOT NULL THEN {pick(SKILLS0, SKILLS1)} END",
    "job_type_skills": f"CASE WHEN lines IS NOT NULL THEN {pick(DICT0, DICT1)} END",
}


def postings_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posting cells (all text) + ``source_row`` (file order) + ``batch``."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(order_lines(spark, sf_dir), orders.o_orderkey == F.col("l_orderkey"), "left")
        .selectExpr("*", f"explode(CASE WHEN {K} % 5 = 0 THEN array(0, 1) ELSE array(0) END) AS copy")
    )
    return base.selectExpr(
        f"{K} * 2 + copy AS source_row",
        f"CAST(({K} + 3 * copy) % {N_BATCHES} AS INT) AS batch",
        *[f"{CELLS_SQL[c]} AS {c}" for c in SOURCE_COLUMNS],
    )


def batch_ingested_at(batch: str = "batch") -> Column:
    """Load time of a batch: every row of one file shares it."""
    return F.expr(f"TIMESTAMP '{BASE_INGEST}' + make_dt_interval(0, {batch} * {BATCH_HOURS}, 0, 0)")
