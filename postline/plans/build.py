"""The three steps of a scheduled run, in order: ingest → models → assertions.

A plain function (the ordering is all there is to schedule): load the
pending files, rebuild every model from the committed landing rows, then run
the quality checks, stopping at the first failing one when ``fail_fast``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from postline.operators.quality import QualitySuite
from postline.plans.ingest import Paths, committed_landing, ingest_files
from postline.plans.models import materialise_models


def run_build(spark: SparkSession, sources: str | Sequence[str], store: Paths, warehouse: str,
              source_name: str = "local_csv", run_ts: datetime | None = None, fail_fast: bool = True):
    """Returns (per-file ingest stats rows, model tables, [(check, failures)])."""
    stats = ingest_files(spark, sources, store, source_name=source_name).collect()
    tables = materialise_models(committed_landing(spark, store), warehouse, run_ts)
    results = QualitySuite().run(tables, fail_fast=fail_fast)
    return stats, tables, results
