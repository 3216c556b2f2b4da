"""Deduplication and merging of postings.

Two shapes of the same result:

* ``dedup_merge`` — the landing rows with their keys are written once, then one
  ``groupBy(business_key)``: the aggregate keeps the earliest record (``min_by``)
  and the skill sets.  A key of few items collects the sets of its rows whole; the
  rows of a larger one are expanded into one row per skill and per (category, skill),
  of which the aggregate keeps the distinct ones (``collect_set``), so a key holding
  a third of all rows is pre-combined in each task before the single shuffle.
* ``dedup_merge_joined`` — window keep-first + two set aggregations + two left
  joins, the literal shape of the relational definition; kept for checking.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postline.functions.columns import business_key
from postline.schemas import BUSINESS_KEY_ORDER, BUSINESS_KEY_TEXT, BUSINESS_KEY_VALUES, SOURCE_COLUMNS
from postline.session import stored

POSTING_COLUMNS = [c for c in SOURCE_COLUMNS if c not in ("job_skills", "job_type_skills")]
WHOLE_ITEMS = 1000  # items (rows, skills and pairs) up to which the sets of a key's rows are collected as they are


def _empty_skills() -> Column:
    return F.array().cast("array<string>")


def _empty_type_skills() -> Column:
    return F.create_map().cast("map<string,array<string>>")


def with_business_key(raw: DataFrame, order: Sequence[str] = BUSINESS_KEY_ORDER) -> DataFrame:
    """P9 on landing rows; ``id`` is renamed ``raw_job_id``."""
    text = [c for c in order if c in BUSINESS_KEY_TEXT]
    values = [c for c in order if c in BUSINESS_KEY_VALUES]
    return raw.select(
        F.col("id").alias("raw_job_id"),
        *[c for c in raw.columns if c not in ("id",)],
        business_key(text, values, order).alias("business_key"),
    )


def _first_order(ts: str = "ingested_at", rid: str = "raw_job_id") -> Column:
    # ascending, NULL timestamps last, then row id
    return F.struct(F.col(ts).isNull(), F.col(ts), F.col(rid))


def keep_first(df: DataFrame, key: str = "business_key", cols: Sequence[str] | None = None) -> DataFrame:
    """A1 via aggregation: earliest row per key (one partial-aggregated shuffle)."""
    cols = list(cols or [c for c in df.columns if c != key])
    return (
        df.groupBy(key)
        .agg(F.min_by(F.struct(*cols), _first_order()).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])
    )


def keep_first_window(df: DataFrame, key: str = "business_key") -> DataFrame:
    """``row_number() over (partition by key order by ingested_at, id) = 1``.

    Spark plans this with a partial WindowGroupLimit before the shuffle, so a
    hot key is cut to one row per task before it moves.
    """
    w = Window.partitionBy(key).orderBy(F.col("ingested_at").asc_nulls_last(), F.col("raw_job_id").asc())
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def trimmed_skills(skills: Column) -> Column:
    """Items of a skill list, trimmed, blanks dropped."""
    return F.filter(F.transform(skills, lambda s: F.trim(s)), lambda s: s != "")


def trimmed_type_pairs(type_skills: Column) -> Column:
    """(category, skill) pairs of a type map, both trimmed, blanks dropped."""
    per_entry = F.transform(
        F.map_entries(type_skills),
        lambda e: F.transform(e["value"], lambda s: F.struct(F.trim(e["key"]).alias("category"),
                                                             F.trim(s).alias("skill"))),
    )
    return F.filter(F.flatten(per_entry), lambda p: (p["category"] != "") & (p["skill"] != ""))


def skill_sets(df: DataFrame, key: str = "business_key") -> DataFrame:
    """A2: distinct sorted skills per key."""
    return (
        df.select(key, F.explode(trimmed_skills(F.col("job_skills"))).alias("skill"))
        .groupBy(key).agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    )


def type_skill_sets(df: DataFrame, key: str = "business_key") -> DataFrame:
    """A3: distinct sorted skills per (key, category)."""
    return (
        df.select(key, F.inline(trimmed_type_pairs(F.col("job_type_skills"))))
        .groupBy(key, "category").agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    )


def fold_categories(sets: DataFrame, key: str = "business_key") -> DataFrame:
    """A4: (key, category, skills) rows → one map per key, keys sorted."""
    return sets.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "skills")))).alias("type_skills"))


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once (a lambda would evaluate a captured one per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_pairs(pairs: Column) -> Column:
    """A3+A4 inside one row: set of (category, skill) → map category → sorted skills.

    In sorted pairs a category is one run: its first places bound the slices, so
    each pair is looked at a fixed number of times.
    """
    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
            F.get(ordered, F.greatest(i - 1, F.lit(0)))["category"] != F.get(ordered, i)["category"]))
        return _bound(starts, lambda s: F.transform(s, lambda i, k: F.struct(
            F.get(ordered, i)["category"].alias("key"),
            F.transform(F.slice(ordered, i + 1, F.coalesce(F.get(s, k + 1), n) - i), lambda p: p["skill"]).alias("value"))))

    return F.map_from_entries(_bound(F.sort_array(pairs), runs))


def _staging_columns(primary: str, skills: Column, type_skills: Column, run_ts: datetime) -> list[Column]:
    return [
        F.col(f"{primary}.raw_job_id").alias("raw_job_id"),
        F.col("business_key"),
        *[F.col(f"{primary}.{c}").alias(c) for c in POSTING_COLUMNS],
        F.coalesce(skills, _empty_skills()).alias("job_skills_array"),
        F.coalesce(type_skills, F.col(f"{primary}.job_type_skills"), _empty_type_skills()).alias("job_type_skills"),
        F.col(f"{primary}.ingested_at").alias("ingested_at"),
        F.lit(run_ts).alias("processed_at"),
    ]


def posting_core(raw: DataFrame, run_ts: datetime) -> DataFrame:
    """The staged rows without their skills: the earliest record per business key.

    Nothing here reads the nested columns, so a plan over it neither parses the
    literals nor expands a row; one shuffle, with a partial per key.
    """
    first = keep_first(with_business_key(raw), cols=["raw_job_id", *POSTING_COLUMNS, "ingested_at"])
    return first.withColumn("processed_at", F.lit(run_ts))


def distinct_pairs(pairs: Column) -> Column:
    """The distinct pairs, sorted: equal neighbours of the sorted ones go, so no pair is compared with every other."""
    return _bound(F.sort_array(pairs), lambda s: F.filter(s, lambda p, i: (i == 0) | (F.get(s, F.greatest(i - 1, F.lit(0))) != p)))


def state_rows(raw: DataFrame) -> DataFrame:
    """(business_key, first, place, skills, pairs) of every landing row: its record with its order and its own sets.

    The map of a record is carried only where it gives no pair: elsewhere the pairs replace it.
    """
    keyed = with_business_key(raw).withColumn("skills", F.coalesce(trimmed_skills(F.col("job_skills")), _empty_skills())).withColumn(
        "pairs", F.coalesce(trimmed_type_pairs(F.col("job_type_skills")), F.array().cast("array<struct<category:string,skill:string>>")))
    return keyed.select(
        "business_key",
        F.struct("raw_job_id", *POSTING_COLUMNS, F.when(F.size("pairs") == 0, F.col("job_type_skills")).alias("job_type_skills"),
                 "ingested_at").alias("first"),
        _first_order().alias("place"), "skills", "pairs")


def merge_states(rows: DataFrame) -> DataFrame:
    """States of one key to one: the earliest first record and the unions of the sets; one shuffle on the key.

    The key and the number of items of the rows are read on their own first, so ``rows`` should be a written copy.  A key with at
    most ``WHOLE_ITEMS`` items in all collects the sets of its rows as they are.  The rows of a larger key
    are expanded to one item a row, so that its aggregate keeps sets, not lists of sets; the
    record rides on one row only, and a key holding a third of all rows is pre-combined in each task.
    """
    large = stored(rows.select("business_key", (1 + F.size("skills") + F.size("pairs")).cast("long").alias("n")).groupBy("business_key")
                   .agg(F.sum("n").alias("n")).where(F.col("n") > WHOLE_ITEMS).select("business_key"))
    pair = "struct<category:string,skill:string>"
    whole = F.struct("first", "place", "skills", "pairs", F.lit(None).cast("string").alias("skill"), F.lit(None).cast(pair).alias("pair"))
    if large.isEmpty():
        parts = rows.select("business_key", whole.alias("i"))
    else:
        fields = rows.select(whole.alias("i")).schema["i"].dataType
        item = fields.simpleString()
        none = {f.name: F.lit(None).cast(f.dataType.simpleString()).alias(f.name) for f in fields.fields}
        one = lambda **has: F.struct(*[has[k].alias(k) if k in has else v for k, v in none.items()]).cast(item)
        items = F.concat(F.array(one(first=F.col("first"), place=F.col("place"))),
                         F.transform("skills", lambda s: one(skill=s)), F.transform("pairs", lambda p: one(pair=p)))
        marked = rows.join(large.withColumn("_large", F.lit(True)), "business_key", "left")
        parts = marked.select("business_key", F.explode(F.when(F.col("_large"), items).otherwise(F.array(whole.cast(item)))).alias("i"))
    merged = parts.groupBy("business_key").agg(
        F.min_by("i.first", "i.place").alias("first"), F.min("i.place").alias("place"),
        F.flatten(F.collect_list("i.skills")).alias("skill_lists"), F.collect_set("i.skill").alias("skill_set"),
        F.flatten(F.collect_list("i.pairs")).alias("pair_lists"), F.collect_set("i.pair").alias("pair_set"))
    return merged.select("business_key", "first", "place", F.array_distinct(F.concat("skill_lists", "skill_set")).alias("skills"),
                         distinct_pairs(F.concat("pair_lists", "pair_set")).alias("pairs"))


def staged(state: DataFrame, run_ts: datetime) -> DataFrame:
    """The staged relation of states."""
    skills = F.when(F.size("skills") > 0, F.sort_array("skills"))
    type_skills = F.when(F.size("pairs") > 0, fold_pairs(F.col("pairs")))
    return state.select(*_staging_columns("first", skills, type_skills, run_ts))


def dedup_merge(raw: DataFrame, run_ts: datetime, keep: Callable[[DataFrame], DataFrame] = stored) -> DataFrame:
    """A5/M1: one row per business key — earliest record + union of all skills.

    ``raw`` is the landing table (``id``, posting columns, nested columns,
    ``ingested_at``).  ``keep`` writes its rows with their keys once, so that the source is
    derived and parsed once; what it gives is read twice, the first time for keys and sizes alone.
    """
    return staged(merge_states(keep(state_rows(raw))), run_ts)


def dedup_merge_joined(raw: DataFrame, run_ts: datetime) -> DataFrame:
    """A5 in relational shape: keep-first window ⟕ skill sets ⟕ folded maps."""
    keyed = with_business_key(raw)
    first = keep_first_window(keyed).select("business_key", F.struct(*keyed.columns).alias("primary"))
    sets = skill_sets(keyed)
    maps = fold_categories(type_skill_sets(keyed))
    joined = first.join(sets, "business_key", "left").join(maps, "business_key", "left")
    return joined.select(*_staging_columns("primary", F.col("skills"), F.col("type_skills"), run_ts))
