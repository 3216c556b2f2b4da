"""Small shared pieces: table reading, written cuts of the plan, running totals."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.session import delete_path, ensure_checkpoint_dir

_WRITTEN: list[str] = []
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Recent(dict):
    """A bounded cache for a task: ``cache[key]`` is ``make(key)``.

    When it is full its entries become the old generation; one that is asked for
    again comes back, the rest go with the next change.  Long texts are not kept.
    """

    def __init__(self, make, most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if isinstance(key, str) and len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def bounded_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of some megabytes, however long they are (one longer text is a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name inside the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Ends the lineage there: a lost executor costs a re-read of the table, never
    a second run of what made it, so the write's shuffle files go with the write.
    The schema is passed on, so an empty table needs no inference.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_at = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote and nothing will read again."""
    for table in tables:
        delete_path(table.sparkSession, table.written_at)
        _WRITTEN.remove(table.written_at)


def release(spark: SparkSession) -> None:
    """Delete the tables that ``cut`` wrote; call it once their readers have ended."""
    while _WRITTEN:
        delete_path(spark, _WRITTEN.pop())


def named(column: str) -> Column:
    """A top-level column by its name, whatever signs it holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with signs behind it while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once.

    A lambda evaluates what it captures for every element, and the optimizer may
    move a projected expression into it; the variable of a lambda stays a value.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(lengths: Column) -> Column:
    """``[x0, x1, ...] -> [0, x0, x0+x1, ...]`` without the full total, as array<bigint>.

    A fold that appends copies its array at each step, so the fold runs over
    blocks of about the root of the size: n items cost n^1.5, not n^2.
    """
    def fold(items: Column, first: Column) -> Column:
        return F.aggregate(
            items,
            F.struct(first.cast("bigint").alias("at"), F.expr("cast(array() as array<bigint>)").alias("seen")),
            lambda acc, x: F.struct(
                (acc["at"] + x.cast("bigint")).alias("at"),
                F.concat(acc["seen"], F.array(acc["at"])).alias("seen"),
            ),
            lambda acc: acc["seen"],
        )

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))

    def blocked(x: Column, width: Column) -> Column:
        part = lambda k: F.slice(x, k * width + 1, width)
        blocks = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / width).cast("int"))
        firsts = fold(F.transform(blocks, lambda k: total(part(k))), F.lit(0))
        return let(firsts, lambda f: F.flatten(F.transform(blocks, lambda k: fold(part(k), F.element_at(f, k + 1)))))

    width = lambda x: F.ceil(F.sqrt(F.size(x).cast("double"))).cast("int")
    return let(lengths, lambda x: F.when(F.size(x) > 0, let(width(x), lambda w: blocked(x, w))).otherwise(
        F.expr("cast(array() as array<bigint>)")))
