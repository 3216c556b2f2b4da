"""Benchmark: the whole build at one scale factor, as a scheduled run does it.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stages (each timed, seconds):
  landing        driver tables → postings cells → typed landing rows, written
  staging        dedup-merge of the landing table, written
  models         the other 12 models from the written staging, written
  quality        the 59-check report over the written models
  star_*         star queries over the written models
  ledger         ledger upsert over the documents table
  e2e_flagship   the registered flagship query straight from the driver tables

Prints one JSON line; ``value`` is the sum of the stage times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postline.operators import quality  # noqa: E402
from postline.plans import doc_ledger, models, registry, star  # noqa: E402
from postline.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16,
                          app="postline-bench")
    out_root = tempfile.mkdtemp(prefix="postline-bench-")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        result = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return result

    # warm the JVM (JIT, codegen caches) on a smaller scale factor; not timed
    for warm in ("sf0.01", "sf0.001"):
        small = sf_dir.rsplit("/", 1)[0] + "/" + warm
        if os.path.isdir(small) and small != sf_dir:
            registry.REGISTRY["avg_salary_country_platform"][0](spark, small).collect()
            break

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    landing_path = f"{out_root}/raw/jobs"
    timed("landing", lambda: models.landing_from_tables(spark, sf_dir).write.mode("overwrite")
          .parquet(landing_path))
    raw = spark.read.parquet(landing_path)
    timed("staging", lambda: models.staging(raw).write.mode("overwrite").parquet(f"{out_root}/staging/stg_raw_jobs"))
    stg = spark.read.parquet(f"{out_root}/staging/stg_raw_jobs")

    def build_rest():
        built = models.build_models(raw, stg=stg)

        def write(name):
            built[name].write.mode("overwrite").parquet(f"{out_root}/models/{name}")
            return name
        with ThreadPoolExecutor(max_workers=int(os.environ.get("BENCH_MODEL_THREADS", "4"))) as pool:
            names = list(pool.map(write, models.MODEL_NAMES[1:]))
        return {"stg_raw_jobs": stg, **{n: spark.read.parquet(f"{out_root}/models/{n}") for n in names}}

    tables = timed("models", build_rest)
    timed("quality", lambda: quality.QualitySuite().report(tables).collect())
    t = tables
    timed("star_fact", lambda: noop(star.fact_from_staging(t["stg_raw_jobs"])))
    timed("star_top_skills", lambda: noop(star.top_skills_from_staging(t["stg_raw_jobs"])))
    timed("star_avg_salary", lambda: noop(star.avg_salary_country_platform(t["job_posting"], t["country"],
                                                                           t["platform"])))
    timed("star_jobs_per_month", lambda: noop(star.jobs_per_month(t["job_posting"], t["company"])))
    timed("star_skill_weight", lambda: noop(star.weights_from_staging(t["stg_raw_jobs"])))
    timed("ledger", lambda: noop(doc_ledger.upserted(spark, sf_dir)))
    timed("e2e_flagship", lambda: registry.REGISTRY["avg_salary_country_platform"][0](spark, sf_dir).collect())

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "postings_build_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
