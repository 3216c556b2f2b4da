"""Session settings the engine relies on, and where durable intermediates go.

The engine never creates its own session on a cluster; it only checks/sets
SQL confs that change *semantics* (time zone, map key policy, ANSI).  Sizing
confs (shuffle partitions, max partition bytes) belong to the deployment and
are only given defaults for local runs and tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Confs that change results, applied to any session handed to the engine.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Python dicts keep the last value of a repeated key; Spark's default throws.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Confs that only change the physical plan, for local runs and tests; a cluster's
# own settings are never touched. AQE re-plans joins from runtime sizes, splits
# skewed partitions and coalesces small ones.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the confs that change results; sizes and thresholds stay as the deployment has them."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "postline") -> SparkSession:
    """Session for tests, bench and local runs (no UI, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("POSTLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only when it is unset and the master is local (tests, local runs) a
    fresh scratch folder is made for this process; anywhere else executors could
    not share it, so that is an error.
    """
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="postline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of a query go when it ends, not when the driver's collector comes upon them.

    For builds of many writes, each of which reads files only: no frame that was shuffled before is run again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Scratch:
    """Written copies of relations that several jobs read, deleted at the end.

    A copy in the shared folder survives the loss of executors (unlike a local
    checkpoint).  Frames read from it must not be used after the ``with`` block.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def cut(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a copy that nothing reads any more."""
        delete_path(self.spark, f"{self.root}/{name}")

    def __exit__(self, *_exc) -> None:
        delete_path(self.spark, self.root)


def stored(df: DataFrame, **options: str) -> DataFrame:
    """A Parquet copy in the shared checkpoint folder, for a relation that several parts of a returned frame read.

    It stays there as long as a checkpoint would; unlike one it is packed, and a reader takes only the columns it needs.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder, for a frame that is returned.

    Survives executor loss (unlike a local checkpoint); the files go with the
    frame where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
