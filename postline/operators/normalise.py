"""Typed landing rows from raw text cells (P1–P6, E1–E3), one ``select``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.functions.columns import clean_bool_sql, clean_decimal_sql, clean_text_sql, null_like_sql, sql_ident, strip_sql
from postline.functions.literals import (clean_dict_cell_sql, clean_list_cell_sql, cleaned_entries_sql, cleaned_list_sql,
                                         parsed_list_sql, parsed_map_sql, register_udfs)
from postline.schemas import BOOL_COLUMNS, DECIMAL_COLUMNS, LIST_COLUMN, MAP_COLUMN, SOURCE_COLUMNS, TEXT_COLUMNS

PROFILE_COLUMNS = [
    "job_skills_missing", "job_skills_invalid", "job_type_skills_missing", "job_type_skills_invalid",
]


def with_missing_columns(src: DataFrame) -> DataFrame:
    """Columns are matched by name; a source column that is absent is NULL."""
    have = set(src.columns)
    missing = [F.lit(None).cast("string").alias(c) for c in SOURCE_COLUMNS if c not in have]
    return src.select("*", *missing) if missing else src


def normalise_postings(src: DataFrame, keep: Sequence[str] = (), profile: bool = True) -> DataFrame:
    """Every source column typed; ``keep`` columns pass through.

    With ``profile`` the four E3 flags (missing/invalid per nested column) are
    added, computed from the same parsed values (each literal is read once).
    Three projections: strip/read, clean, finish; expressions are given as
    SQL text so a plan costs a handful of driver→JVM calls.
    """
    register_udfs(src.sparkSession)
    src = with_missing_columns(src)
    flat = [c for c in SOURCE_COLUMNS if c not in (LIST_COLUMN, MAP_COLUMN)]
    q = sql_ident
    keep_q = [q(k) for k in keep]
    read = src.selectExpr(
        *keep_q,
        *[q(c) for c in flat],
        *[f"{strip_sql(q(c))} AS {q('_s_' + c)}" for c in flat],
        f"{null_like_sql(q(LIST_COLUMN))} AS _m_list",
        f"{null_like_sql(q(MAP_COLUMN))} AS _m_map",
        f"{parsed_list_sql(q(LIST_COLUMN))} AS _p_list",
        f"{parsed_map_sql(q(MAP_COLUMN))} AS _p_map",
        f"{clean_list_cell_sql(q(LIST_COLUMN))} AS _k_list",
        f"{clean_dict_cell_sql(q(MAP_COLUMN))} AS _k_map",
    )

    def typed_sql(c: str) -> str:
        x, s = q(c), q("_s_" + c)
        if c in TEXT_COLUMNS:
            return clean_text_sql(x, s)
        if c in BOOL_COLUMNS:
            return clean_bool_sql(x, s)
        return clean_decimal_sql(x, *DECIMAL_COLUMNS[c], s=s)

    cleaned = read.selectExpr(
        *keep_q,
        *[f"{typed_sql(c)} AS {q(c)}" for c in flat],
        f"{cleaned_list_sql('_p_list', '_k_list')} AS _c_list",
        f"{cleaned_entries_sql('_p_map', '_k_map')} AS _c_map",
        "_m_list", "_m_map",
    )
    final = {
        LIST_COLUMN: "CASE WHEN size(_c_list) > 0 THEN _c_list END",
        MAP_COLUMN: "CASE WHEN size(_c_map) > 0 THEN map_from_entries(_c_map) END",
    }
    flags = [
        "_m_list AS job_skills_missing",
        "NOT _m_list AND NOT coalesce(size(_c_list) > 0, false) AS job_skills_invalid",
        "_m_map AS job_type_skills_missing",
        "NOT _m_map AND NOT coalesce(size(_c_map) > 0, false) AS job_type_skills_invalid",
    ] if profile else []
    return cleaned.selectExpr(
        *keep_q,
        *[f"{final[c]} AS {q(c)}" if c in final else q(c) for c in SOURCE_COLUMNS],
        *flags,
    )
