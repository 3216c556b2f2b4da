"""The ingest job over CSV files that Spark writes from the driver tables.

The files are the input of the job: one per batch of postings, in the order of
their source rows, in a scratch folder next to the store that the job fills.  What
a query returns is checkpointed, so the folder goes with the query.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions.columns import map_text
from postline.plans.ingest import (
    Paths, _exists, committed_landing, ingest_files, read_entries, sampled_landing,
)
from postline.schemas import BOOL_COLUMNS, DECIMAL_COLUMNS, SOURCE_COLUMNS, TEXT_COLUMNS
from postline.session import Scratch, cut_lineage, delete_path
from postline.sources import files
from postline.sources.driver_tables import postings_source, read_table

FIRST_RUN, SECOND_RUN = datetime(2024, 5, 1, 12), datetime(2024, 6, 1, 12)
SAMPLE_ROWS = 50
RANGE_ORDERS = 250_000  # orders in a sorted range of the files


def write_posting_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """One header CSV per batch of the posting cells, rows in source order.

    A batch is sorted and written in ranges of source rows, each of a bounded number of orders and
    in whatever task; a task per file then puts the ranges one after the other, a block at a time.
    """
    keys = read_table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 2).alias("row"))
    ranges = keys.count() // RANGE_ORDERS + 1
    bounds = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(keys.agg(F.percentile_approx("row", shares, 100 * ranges)).first()[0] or []))
    cells = (postings_source(spark, sf_dir).withColumn("range", F.expr(_place_sql("source_row", bounds, 0, len(bounds))))
             .repartition("batch", "range").sortWithinPartitions("batch", "range", "source_row"))
    parts = f"{folder}-ranges"
    (cells.select("batch", "range", *SOURCE_COLUMNS).write.partitionBy("batch", "range")
     .option("header", "false").option("quoteAll", "true").option("escape", '"').option("compression", "gzip").csv(parts))
    head = ",".join(f'"{c}"' for c in SOURCE_COLUMNS) + "\n"
    files.join_files(spark, _by_batch(spark, parts, folder), head.encode(), "gzip")
    delete_path(spark, parts)
    return folder


def _place_sql(x: str, bounds: list[int], low: int, high: int) -> str:
    """How many of the sorted bounds ``x`` has reached, by halving."""
    if low == high:
        return str(low)
    mid = (low + high) // 2
    return (f"CASE WHEN {x} < {bounds[mid]} THEN {_place_sql(x, bounds, low, mid)} "
            f"ELSE {_place_sql(x, bounds, mid + 1, high)} END")


def _by_batch(spark: SparkSession, parts: str, folder: str) -> dict[str, list[str]]:
    """The file of every batch and the files of its ranges in order (names alone)."""
    listed = spark.read.format("binaryFile").load(parts).inputFiles() if _exists(spark, parts) else []
    found: dict[str, list[tuple]] = {}
    for path in (unquote(p) for p in listed):
        batch, number, name = path.split("/")[-3:]
        found.setdefault(f"{folder}/{batch}/postings.csv", []).append((int(number.split("=")[1]), name, path))
    return {target: [path for *_, path in sorted(ranges)] for target, ranges in found.items()}


def write_order_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """16 files of order numbers and priorities, a header line first."""
    orders = read_table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 16).alias("part"), F.col("o_orderkey").alias("at"),
        F.concat(F.lit('"'), F.col("o_orderkey").cast("string"), F.lit('","'), F.col("o_orderpriority"), F.lit('"')).alias("line"))
    heads = orders.select("part").distinct().select("part", F.lit(-1).cast("long").alias("at"), F.lit("job_title,job_via").alias("line"))
    (orders.unionByName(heads).repartition("part").sortWithinPartitions("part", "at").select("part", "line")
     .write.partitionBy("part").text(folder))
    return folder


def _values(landed: DataFrame) -> DataFrame:
    return landed.select(
        *TEXT_COLUMNS, *BOOL_COLUMNS, *DECIMAL_COLUMNS, F.array_join("job_skills", "|").alias("skills_text"),
        map_text("job_type_skills").alias("type_skills_text"))


def _load_twice(spark: SparkSession, sf_dir: str, root: str) -> Paths:
    """Two runs over the same files: the second one finds nothing to do."""
    folder, store = write_posting_files(spark, sf_dir, f"{root}/csv"), Paths(f"{root}/raw", f"{root}/ledger")
    for now in (FIRST_RUN, SECOND_RUN):
        ingest_files(spark, folder, store, source_name="orders", now=now)
    return store


def landed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows that two loads of the files leave, without ids."""
    with Scratch(spark) as scratch:
        return cut_lineage(_values(committed_landing(spark, _load_twice(spark, sf_dir, scratch.root))))


def landed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the landed rows: dense over all files, dense inside each, one load time."""
    with Scratch(spark) as scratch:
        rows = committed_landing(spark, _load_twice(spark, sf_dir, scratch.root))
        per_file = rows.groupBy("file_md5").agg(
            F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), F.countDistinct("id").alias("ids"),
            F.min("ingested_at").alias("loaded_at"), F.countDistinct("ingested_at").alias("times"))
        dense = (F.col("ids") == F.col("n")) & (F.col("high") - F.col("low") + 1 == F.col("n")) & (F.col("times") == 1)
        return cut_lineage(per_file.agg(
            F.count("*").alias("files"), F.sum(dense.cast("long")).alias("dense_files"), F.sum("n").alias("n_rows"),
            F.min("low").alias("min_id"), F.max("high").alias("max_id"), F.min("loaded_at").alias("loaded_at")))


def run_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of two runs over the same files entered into the ledger."""
    with Scratch(spark) as scratch:
        entries = read_entries(spark, _load_twice(spark, sf_dir, scratch.root))
        counters = ["total_rows", "inserted_rows", "parse_warnings", "job_skills_missing", "job_skills_invalid",
                    "job_type_skills_missing", "job_type_skills_invalid"]
        return cut_lineage(entries.groupBy("started_at", "status").agg(
            F.count("*").alias("files"), *[F.sum(c).alias(c) for c in counters]))


def sampled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of every file after a smoke load, which a whole load before and after it does not touch."""
    with Scratch(spark) as scratch:
        folder, store = write_posting_files(spark, sf_dir, f"{scratch.root}/csv"), Paths(f"{scratch.root}/raw", f"{scratch.root}/ledger")
        ingest_files(spark, folder, store, source_name="smoke", now=FIRST_RUN, sample_rows=SAMPLE_ROWS)
        whole = ingest_files(spark, folder, store, source_name="orders", now=SECOND_RUN).agg(
            F.sum("inserted_rows").alias("whole_rows"), F.sum(F.col("skipped").cast("long")).alias("whole_skipped"))
        return cut_lineage(_values(sampled_landing(spark, store)).crossJoin(whole))  # one row


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: fingerprint, size, header and kind of every file, from the scan."""
    with Scratch(spark) as scratch:
        rows = files.scan_files(spark, write_order_files(spark, sf_dir, f"{scratch.root}/orders"))
        return cut_lineage(rows.select("file_md5", "size", F.array_join("header", ",").alias("header"), "multiline", "problem"))
