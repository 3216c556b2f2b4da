"""Exploding nested skills into rows.

The row-level builders (``flat_skill_names``, ``typed_skill_pairs``) are the
single definition of which (skill) and (category, skill) values a staged
posting carries; the exploded relations and the bridge both use them.
Explodes are generators inside a task: no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.columns import assignment_id


def flat_skill_names(skills: Column) -> Column:
    """Skill names of a posting's list: ``lower(trim(x))``, blanks dropped."""
    return F.filter(F.transform(skills, lambda s: F.lower(F.trim(s))), lambda s: s.isNotNull() & (s != ""))


def typed_skill_pairs(type_skills: Column) -> Column:
    """(category, skill) of a posting's map, lowered and trimmed, blanks dropped (E5+E6)."""
    entries = F.filter(F.map_entries(type_skills), lambda e: F.trim(e["key"]) != "")
    pairs = F.flatten(F.transform(
        entries,
        lambda e: F.transform(F.coalesce(e["value"], F.array().cast("array<string>")),
                              lambda s: F.struct(F.lower(F.trim(e["key"])).alias("skill_category"),
                                                 F.lower(F.trim(s)).alias("skill_name"))),
    ))
    return F.filter(pairs, lambda p: p["skill_name"].isNotNull() & (p["skill_name"] != ""))


def explode_list(df: DataFrame, col: str, alias: str, keep: list[str]) -> DataFrame:
    """One row per array item; NULL/empty arrays give no row."""
    return df.select(*keep, F.explode(col).alias(alias))


def explode_map(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """E5: one row per map entry (key, value)."""
    return df.select(*keep, F.explode(col).alias("key", "value"))


def job_skills_exploded(stg: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Posting × skill from the flat list; ``keep`` may write the rows, without their ids, once for several readers."""
    rows = keep(stg.where(F.size("job_skills_array") > 0).select(
        "raw_job_id", "business_key", "ingested_at",
        F.explode(flat_skill_names(F.col("job_skills_array"))).alias("skill_name")))
    return rows.select(
        assignment_id("raw_job_id", "skill_name").alias("skill_assignment_id"),
        "raw_job_id", "business_key", "skill_name", "ingested_at")


def job_type_skills_exploded(stg: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Posting × category × skill from the grouped map; ``keep`` as in ``job_skills_exploded``."""
    rows = keep(stg.where(F.col("job_type_skills").isNotNull()).select(
        "raw_job_id", "business_key", "ingested_at",
        F.inline(typed_skill_pairs(F.col("job_type_skills")))))
    return rows.select(
        assignment_id("raw_job_id", "skill_category", "skill_name").alias("grouped_skill_assignment_id"),
        "raw_job_id", "business_key", "skill_name", "skill_category", "ingested_at")


def json_props_exploded(events: DataFrame) -> DataFrame:
    """E5 on a JSON text column: ``props`` → (event_id, prop_key, prop_value) rows."""
    props = F.from_json(F.col("props"), "map<string,bigint>")
    return events.select("event_id", F.explode(props).alias("prop_key", "prop_value"))


def json_items(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """P15 on raw JSON text: (id, key, item) of the members of an object, dispatched by type at run time.

    A list gives its elements; any other value is a list of itself, so a scalar gives its
    text and an object its JSON.  JSON nulls, blank keys and blank items give nothing, nor
    does a cell that is no JSON or no object (an array has no keys).  Keys and items are
    stripped; an element that is a list or an object itself is its JSON.
    """
    members = df.select(F.col(id_col).alias("id"), F.try_parse_json(F.col(json_col)).alias("v"))
    rows = df.sparkSession.sql(
        "SELECT id, trim(e.key) AS key, explode(coalesce(try_variant_get(e.value, '$', 'array<variant>'), array(e.value))) AS item "
        "FROM {members}, LATERAL variant_explode(v) AS e WHERE schema_of_variant(v) LIKE 'OBJECT<%' AND trim(e.key) <> ''",
        members=members)
    kind = F.expr("schema_of_variant(item)")
    text = (F.when(kind == "VOID", None).when(kind.rlike("^(OBJECT|ARRAY)<"), F.to_json("item"))
            .otherwise(F.expr("try_variant_get(item, '$', 'string')")))
    return rows.select(F.col("id").alias(id_col), "key", F.trim(text).alias("item")).where("item <> ''")


def nested_as_json(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """array/map/struct columns written as JSON text (for text exports)."""
    from pyspark.sql.types import ArrayType, MapType, StructType
    nested_types = (ArrayType, MapType, StructType)
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, nested_types)}
    return df.select(*[F.to_json(c).alias(c) if c in targets else F.col(c) for c in df.columns])
