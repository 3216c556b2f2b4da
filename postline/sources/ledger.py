"""The load ledger: one row per file fingerprint.

A file whose fingerprint has a *completed* row is not read again.  The
ledger row is written after the file's landing partition, so it is the
commit marker: readers keep landing rows whose fingerprint is completed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.schemas import LEDGER_SCHEMA, LEDGER_STATUSES

COUNTERS = ["total_rows", "inserted_rows", "parse_warnings", "job_skills_missing", "job_skills_invalid",
            "job_type_skills_missing", "job_type_skills_invalid"]


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def completed(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == "completed")


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files with no completed load.

    Files are first reduced to one path per fingerprint (the smallest path), so
    equal copies load once.
    """
    one_per_hash = files.groupBy("file_md5").agg(
        F.min_by(F.struct(*[c for c in files.columns if c != "file_md5"]), F.col("file_path")).alias("_f")
    ).select("file_md5", "_f.*")
    return one_per_hash.join(completed(ledger).select("file_md5"), "file_md5", "left_anti")


def already_loaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose fingerprint has a completed load (semi join)."""
    return files.join(completed(ledger).select("file_md5"), "file_md5", "left_semi")


def run_entries(stats: DataFrame, run_started: datetime, run_finished: datetime,
                status: str = "completed") -> DataFrame:
    """Ledger rows of one run from per-file stats (file_md5, file_path, source_name, counters)."""
    return stats.select(
        "file_md5", "file_path", "source_name", F.lit(status).alias("status"),
        *[F.col(c).cast("long").alias(c) for c in COUNTERS],
        F.lit(run_started).alias("started_at"), F.lit(run_finished).alias("finished_at"),
    )


def upsert_ledger(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    """Insert new fingerprints; on a known one update status, counters and
    finish time, and keep the stored path, source and start time."""
    old = ledger.alias("o")
    new = entries.alias("n")
    joined = old.join(new, F.col("o.file_md5") == F.col("n.file_md5"), "full_outer")
    has_new = F.col("n.file_md5").isNotNull()

    def newer(c: str):
        return F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    def kept(c: str):
        return F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c)

    return joined.select(
        F.coalesce(F.col("o.file_md5"), F.col("n.file_md5")).alias("file_md5"),
        kept("file_path"), kept("source_name"), newer("status"),
        *[newer(c) for c in COUNTERS], kept("started_at"), newer("finished_at"),
    )


def fold_entries(entries: DataFrame) -> DataFrame:
    """The ledger (a row per fingerprint) from the entries of all runs.

    The first completed load of a fingerprint stands, else its last attempt; path,
    source and start time are those of the first entry.  Skips of a known
    fingerprint change nothing.
    """
    at = F.struct(F.col("finished_at"), F.col("run_id"), F.col("file_path"))
    done, tried = F.col("status") == "completed", F.col("status") != "skipped"
    row = F.struct(*entries.columns)
    one = entries.groupBy("file_md5").agg(
        F.min_by(row, F.when(done, at)).alias("done"), F.max_by(row, F.when(tried, at)).alias("last"),
        F.min_by(row, F.when(tried, at)).alias("first")).where("last is not null")
    kept = F.coalesce("done", "last")
    origin = {"file_path", "source_name", "started_at"}
    return one.select(*[(F.col("first") if c in origin else kept)[c].alias(c) for c in entries.columns])


def invalid_status(ledger: DataFrame) -> DataFrame:
    """Rows whose status is outside the allowed domain."""
    return ledger.where(~F.col("status").isin(LEDGER_STATUSES) | F.col("status").isNull())


def latest_runs(ledger: DataFrame, k: int = 5) -> DataFrame:
    """O2: the ``k`` most recently finished loads (unfinished first), ties by fingerprint."""
    return ledger.orderBy(F.col("finished_at").desc_nulls_first(), F.col("file_md5").asc()).limit(k)


def exists(df: DataFrame) -> bool:
    """O3: does the frame hold at least one row (a LIMIT 1 probe)."""
    return len(df.limit(1).take(1)) > 0
