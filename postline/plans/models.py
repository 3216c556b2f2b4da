"""The model graph (M1–M13) as plain functions over DataFrames.

    landing → stg_raw_jobs → {job_skills_exploded, job_type_skills_exploded,
                              6 dimensions, job_posting}
    {exploded} → skill, skill_category;  stg → job_skill

``build_models`` returns lazy DataFrames.  ``materialise_models`` writes
the staged relation once (it has nine consumers) and every model to parquet
under one root, the way a scheduled build would.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.operators import bridge, dedup, dimensions, nested
from postline.operators.normalise import normalise_postings
from postline.session import Scratch, stored
from postline.sources.driver_tables import batch_ingested_at, postings_source

# Processing time of the registered queries, so that they can be checked; every
# other build takes the time at which it starts.
RUN_TS = datetime(2025, 1, 1, 0, 0, 0)


def _time(run_ts: datetime | None) -> datetime:
    return run_ts or datetime.now(timezone.utc).replace(tzinfo=None)

MODEL_NAMES = [
    "stg_raw_jobs", "stg_job_skills_exploded", "stg_job_type_skills_exploded",
    "company", "country", "platform", "schedule_type", "salary_rate_type", "job_title_category",
    "skill", "skill_category", "job_posting", "job_skill",
]


def landing_from_tables(spark: SparkSession, sf_dir: str, profile: bool = False) -> DataFrame:
    """Landing rows (raw.jobs shape) derived from the driver tables."""
    src = postings_source(spark, sf_dir)
    typed = normalise_postings(src, keep=["source_row", "batch"], profile=profile)
    extra = ["job_skills_missing", "job_skills_invalid", "job_type_skills_missing",
             "job_type_skills_invalid"] if profile else []
    return typed.select(
        F.col("source_row").alias("id"),
        *[c for c in typed.columns if c not in ("source_row", "batch") and c not in extra],
        batch_ingested_at("batch").alias("ingested_at"),
        *extra,
    )


def staging(raw: DataFrame, run_ts: datetime | None = None, keep=stored) -> DataFrame:
    return dedup.dedup_merge(raw, _time(run_ts), keep)


def posting_models(core: DataFrame, run_ts: datetime | None = None) -> dict[str, DataFrame]:
    """The six dimensions of posting columns and the posting entity, from rows without skills.

    ``core`` is ``dedup.posting_core`` (nothing nested is read) or the staged rows.
    """
    run_ts = _time(run_ts)
    out = {name: dimensions.dimension(core, name, run_ts) for name in dimensions.DIMENSIONS}
    out["job_posting"] = bridge.job_posting(core, run_ts)
    return out


def build_models(raw: DataFrame, run_ts: datetime | None = None, stg: DataFrame | None = None) -> dict[str, DataFrame]:
    run_ts = _time(run_ts)
    stg = stg if stg is not None else staging(raw, run_ts)
    flat = nested.job_skills_exploded(stg)
    grouped = nested.job_type_skills_exploded(stg)
    out = {"stg_raw_jobs": stg, "stg_job_skills_exploded": flat, "stg_job_type_skills_exploded": grouped}
    out |= posting_models(stg, run_ts)
    out["skill"] = dimensions.skill(flat, grouped, run_ts)
    out["skill_category"] = dimensions.skill_category(grouped, run_ts)
    out["job_skill"] = bridge.job_skill(stg, run_ts)
    return out


LAYER = {"stg_raw_jobs": "staging", "stg_job_skills_exploded": "staging",
         "stg_job_type_skills_exploded": "staging", "job_skill": "marts"}


def model_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{LAYER.get(name, 'core')}/{name}"


def materialise_models(raw: DataFrame, root: str, run_ts: datetime | None = None,
                       parallelism: int = 4) -> dict[str, DataFrame]:
    """Write every model as parquet under ``root`` (overwrite) and read them back.

    The staged relation is written first; the other twelve models are built
    from the written copy (so the dedup shuffle runs once and lineage is cut at
    a durable, shared location) and, being independent of each other, are
    submitted as concurrent Spark jobs from ``parallelism`` driver threads.
    """
    spark, run_ts = raw.sparkSession, _time(run_ts)
    with Scratch(spark) as scratch:
        staging(raw, run_ts, lambda rows: scratch.cut(rows, "states")).write.mode("overwrite").parquet(model_path(root, "stg_raw_jobs"))
    stg = spark.read.parquet(model_path(root, "stg_raw_jobs"))
    models = build_models(raw, run_ts, stg=stg)

    def write(name: str) -> str:
        models[name].write.mode("overwrite").parquet(model_path(root, name))
        return name

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = list(pool.map(write, MODEL_NAMES[1:]))
    return {"stg_raw_jobs": stg, **{n: spark.read.parquet(model_path(root, n)) for n in done}}


def shared_models(raw: DataFrame, run_ts: datetime | None = None) -> dict[str, DataFrame]:
    """Models for one query that uses several of them: the staged relation is
    stored once (shared checkpoint folder) instead of being re-derived by
    every consumer."""
    run_ts = _time(run_ts)
    return build_models(raw, run_ts, stg=stored(staging(raw, run_ts)))


def checked_models(raw: DataFrame, run_ts: datetime | None = None, parallelism: int = 4) -> dict[str, DataFrame]:
    """Models for a report that reads each of them several times.

    Beside the staged relation every model that takes an explode or a distinct is stored once:
    the exploded rows (their ids are hashed by the reader), the bridge, then the dimensions.
    """
    run_ts = _time(run_ts)
    stg = stored(staging(raw, run_ts))
    out = {"stg_raw_jobs": stg, **posting_models(stg, run_ts), "job_skill": bridge.job_skill(stg, run_ts)}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        flat = pool.submit(nested.job_skills_exploded, stg, stored)
        grouped = pool.submit(nested.job_type_skills_exploded, stg, stored)
        kept = {n: pool.submit(stored, out[n]) for n in ("job_skill", *dimensions.DIMENSIONS)}
        out |= {"stg_job_skills_exploded": flat.result(), "stg_job_type_skills_exploded": grouped.result()}
        kept["skill"] = pool.submit(stored, dimensions.skill(flat.result(), grouped.result(), run_ts))
        kept["skill_category"] = pool.submit(stored, dimensions.skill_category(grouped.result(), run_ts))
        return out | {n: k.result() for n, k in kept.items()}


def skill_dimension(raw: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Both exploded relations read one stored copy of what they need of the staged relation."""
    run_ts = _time(run_ts)
    stg = stored(staging(raw, run_ts).select(
        "raw_job_id", "business_key", "ingested_at", "job_skills_array", "job_type_skills"))
    return dimensions.skill(nested.job_skills_exploded(stg), nested.job_type_skills_exploded(stg), run_ts)
