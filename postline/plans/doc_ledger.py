"""The load ledger run over the driver's ``documents`` table.

Each document stands for one source file: its path is
``documents/<source>/<doc_id>.txt``, its content fingerprint is ``md5(text)``
(exact copies share it) and its row count is its number of lines.  A prior
run is derived from ``labels``: labelled documents were loaded before —
completed when ``quality = 1``, failed otherwise.  The current run loads the
pending files and merges its entries into the ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.plans.models import RUN_TS
from postline.sources import ledger
from postline.sources.driver_tables import read_table

# Fixed values of the derived prior run.
PRIOR_START = "2024-01-01 00:00:00"


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 over documents: (file_path, file_md5, source_name, total_rows)."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        F.concat(F.lit("documents/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                 F.lit(".txt")).alias("file_path"),
        F.md5("text").alias("file_md5"),
        F.col("source").alias("source_name"),
        F.size(F.split("text", "\n")).cast("long").alias("total_rows"),
    )


def prior_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of the earlier run: one row per fingerprint (lowest doc id wins)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = docs.join(labels, "doc_id").select(
        F.md5("text").alias("file_md5"), "doc_id",
        F.concat(F.lit("documents/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                 F.lit(".txt")).alias("file_path"),
        F.col("source").alias("source_name"),
        F.when(F.col("quality") == 1, "completed").otherwise("failed").alias("status"),
        F.size(F.split("text", "\n")).cast("long").alias("lines"),
    )
    one = rows.groupBy("file_md5").agg(F.min_by(F.struct(*rows.columns), F.col("doc_id")).alias("r")).select("r.*")
    done = F.col("status") == "completed"
    started = F.to_timestamp(F.lit(PRIOR_START)) + F.make_dt_interval(mins=F.col("doc_id"))
    return one.select(
        "file_md5", "file_path", "source_name", "status",
        F.col("lines").alias("total_rows"),
        F.when(done, F.col("lines")).otherwise(F.lit(0)).cast("long").alias("inserted_rows"),
        *[F.lit(0).cast("long").alias(c) for c in ledger.COUNTERS[2:]],
        started.alias("started_at"),
        F.when(done, started + F.make_dt_interval(secs=F.lit(30))).alias("finished_at"),
    )


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prior ledger after this run loaded every pending file."""
    files = document_files(spark, sf_dir)
    prior = prior_ledger(spark, sf_dir)
    todo = ledger.pending_files(files, prior)
    stats = todo.select(
        "file_md5", "file_path", "source_name", "total_rows", F.col("total_rows").alias("inserted_rows"),
        *[F.lit(0).cast("long").alias(c) for c in ledger.COUNTERS[2:]])
    entries = ledger.run_entries(stats, RUN_TS, RUN_TS)
    return ledger.upsert_ledger(prior, entries)


def entries_of_runs(spark: SparkSession, sf_dir: str, runs: int = 3) -> DataFrame:
    """Entries of several runs over the documents: each run fails, skips or completes a file by its number."""
    docs = read_table(spark, sf_dir, "documents").withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(runs))))
    status = F.element_at(F.array(*map(F.lit, ["failed", "skipped", "completed", "failed"])), ((F.col("doc_id") + F.col("r")) % 4 + 1).cast("int"))
    started = F.to_timestamp(F.lit(PRIOR_START)) + F.make_dt_interval(days=F.col("r"), secs=F.col("doc_id").cast("decimal(18,6)"))
    return docs.select(
        F.md5("text").alias("file_md5"),
        F.concat(F.lit("documents/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_path"),
        F.col("source").alias("source_name"), status.alias("status"), F.col("n_chars").alias("total_rows"),
        *[F.lit(0).cast("long").alias(c) for c in ledger.COUNTERS[1:]],
        started.alias("started_at"), started.alias("finished_at"),
        F.concat(F.lit("run"), F.col("r").cast("string")).alias("run_id"), F.col("doc_id").alias("id_before"))
