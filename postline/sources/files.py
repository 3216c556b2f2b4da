"""File-level sources: content scan and CSV scan by column name.

A posting file is read with every column as text (no inference) and columns
are matched by *name* (each file's own header): a missing column becomes
NULL, extra named columns are ignored, and a row with more fields than the
header is flagged (``_extra``).

One pass over each file, in blocks and inside the tasks, gives its fingerprint,
its header record and whether a quoted field holds a line break; a file of any
size and any compression that the CSV reader knows is scanned the same way.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import re
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postline.operators.normalise import with_missing_columns
from postline.schemas import SOURCE_COLUMNS

BLOCK_BYTES = 1 << 20
PACKED = {".gz": "gzip", ".bz2": "bz2"}

SCAN_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()), T.StructField("file_md5", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("header", T.ArrayType(T.StringType())),
    T.StructField("multiline", T.BooleanType()), T.StructField("problem", T.StringType()),
])


def file_key(path: Column, encoded: bool) -> Column:
    """One spelling of a file's path: ``%`` codes resolved, one slash after ``file:``.

    Spark names a file in its plain form in a listing and in its encoded form in
    the metadata of a row.
    """
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path
    return F.regexp_replace(plain, "^file:/+", "file:/")


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file_path): all files that the paths, folders and patterns name, those without a byte too.

    Spark's own listing, which the driver holds anyway; contents are not read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("binaryFile").load(paths).inputFiles()
    return spark.createDataFrame([(p,) for p in listed], "file_path string").select(
        file_key(F.col("file_path"), True).alias("file_path"))


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path:
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


def open_file(path: str):
    """A binary stream of a file named as Spark names it."""
    store, name = _store(path)
    return store.open_input_stream(name, compression=None)


def join_files(spark: SparkSession, joined: dict[str, list[str]], head: bytes, packed: str | None = None) -> None:
    """Write each file (a key) from a head and the contents of its parts in order, a block at a time in a task per file.

    ``packed`` names the compression of the parts.  A file gets its name when it is whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for target, parts in zip(*(column.to_pylist() for column in batch.columns)):
                store, name = _store(target)
                folder, _, last = name.rpartition("/")
                store.create_dir(folder, recursive=True)
                own = f"{folder}/.{last}-{uuid.uuid4().hex}"  # listings leave hidden files out
                with store.open_output_stream(own, compression=None) as out:
                    out.write(head)
                    for part in parts:
                        with open_file(part) as raw:
                            text = pa.CompressedInputStream(raw, packed) if packed else raw
                            for block in iter(lambda: text.read(BLOCK_BYTES), b""):
                                out.write(block)
                store.move(own, name)
                yield batch.slice(0, 0).select([0])

    rows = spark.createDataFrame(list(joined.items()), "target string, parts array<string>")
    rows.repartition(max(1, len(joined))).mapInArrow(run, "target string").write.format("noop").mode("overwrite").save()


class _Hashed(io.RawIOBase):
    """Reads through a stream and keeps the md5 and size of all that was read."""

    def __init__(self, stream):
        self.stream, self.md5, self.size = stream, hashlib.md5(), 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        block = self.stream.read(len(buffer))
        self.md5.update(block)
        self.size += len(block)
        buffer[:len(block)] = block
        return len(block)


def _lines_over_quotes(blocks: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
    """Each block, and whether a line break stood inside quotes so far."""
    inside = found = False
    for block in blocks:
        for k, part in enumerate(block.split(b'"')):
            if k:
                inside = not inside
            found = found or (inside and b"\n" in part)
        yield block, found


def _header(blocks: list[bytes]) -> list[str]:
    """The first CSV record of the text that begins with the blocks."""
    text = codecs.getincrementaldecoder("utf-8-sig")(errors="replace").decode(b"".join(blocks))
    return next(csv.reader(io.StringIO(text, newline="")), [])


def scan_file(path: str) -> tuple:
    """(md5, size, header, multiline, problem) of one file, read once in blocks."""
    raw = None
    try:
        with open_file(path) as stream:
            raw = _Hashed(stream)
            packed = next((kind for end, kind in PACKED.items() if path.lower().endswith(end)), None)
            text = io.BufferedReader(raw, BLOCK_BYTES)
            if packed:
                text = pa.CompressedInputStream(pa.PythonFile(text, mode="r"), packed)
            head: list[bytes] = []
            header: list[str] | None = None
            multiline = False
            for block, multiline in _lines_over_quotes(iter(lambda: text.read(BLOCK_BYTES), b"")):
                if header is None:
                    head.append(block)
                    record = b"".join(head)
                    # a record ends at a line break outside quotes: an even number of quotes before it
                    ends = (m.start() for m in re.finditer(b"\n", record))
                    if any(record.count(b'"', 0, e) % 2 == 0 for e in ends):
                        header, head = _header(head), []
            header = _header(head) if header is None else header
            while raw.readinto(bytearray(BLOCK_BYTES)):  # what follows the end of a packed stream
                pass
        known = set(header) & set(SOURCE_COLUMNS)
        return raw.md5.hexdigest(), raw.size, header, multiline, None if known else "no known column in the header"
    except (OSError, EOFError, pa.ArrowInvalid) as error:
        return raw.md5.hexdigest() if raw else "", raw.size if raw else 0, [], False, f"unreadable: {error}"[:300]


def scan_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S3: (file_path, file_md5, size, header, multiline, problem) with a row for each file."""
    listed = list_files(spark, paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                row = (path, *scan_file(path))
                yield pa.RecordBatch.from_pylist([dict(zip(SCAN_SCHEMA.names, row))], pa.schema([
                    ("file_path", pa.string()), ("file_md5", pa.string()), ("size", pa.int64()),
                    ("header", pa.list_(pa.string())), ("multiline", pa.bool_()), ("problem", pa.string())]))

    return listed.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(run, SCAN_SCHEMA)


def fingerprint_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S3: (file_path, file_md5, size) from whole-file content, read in blocks."""
    return scan_files(spark, paths).select("file_path", "file_md5", "size")


# Read empty cells as '' (the cleaning treats '' as no value); a value no file holds stands for NULL.
_NO_NULL_TOKEN = "\u0001postline-no-null\u0001"


def read_scanned(spark: SparkSession, scanned: DataFrame) -> DataFrame:
    """Header CSV, quoted fields with doubled quotes, line breaks inside quotes.

    Files are grouped by header and by whether a quoted field holds a line break;
    each group is read with a positional schema named after its header, plus a
    trailing ``_extra`` that catches fields beyond it (also an empty one).  Files
    without such line breaks are split by the reader, so one large file is many
    tasks.  Adds ``_file`` (key of the path) and ``_row`` (increasing in file order
    within a read partition, which its upper bits number).

    The paths of a group go through the driver, as any list of paths to read does.
    """
    groups = (scanned.groupBy("header", "multiline").agg(F.sort_array(F.collect_list("file_path")).alias("paths"))
              .orderBy(F.col("header").cast("string"), "multiline").collect())
    frames = []
    for group in groups:
        header = list(group["header"])
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))]
                              + [T.StructField("_extra", T.StringType())])
        df = (spark.read.schema(schema).option("header", "true").option("multiLine", str(group["multiline"]).lower())
              .option("escape", '"').option("quote", '"').option("nullValue", _NO_NULL_TOKEN).option("emptyValue", "")
              .option("mode", "PERMISSIVE").option("enforceSchema", "true").csv(group["paths"]))
        named, seen = [], set()
        for i, name in enumerate(header):
            if name not in seen:           # a repeated header name keeps its first column
                seen.add(name)
                named.append(F.col(f"_c{i}").alias(name))
        row, file = F.monotonically_increasing_id(), file_key(F.col("_metadata.file_path"), True)
        wanted = [c for c in named]
        df = df.select(*wanted, "_extra", file.alias("_file"), row.alias("_row"))
        df = with_missing_columns(df)
        frames.append(df.select(*SOURCE_COLUMNS, "_extra", "_file", "_row"))
    if not frames:
        text = ", ".join(f"{c} string" for c in [*SOURCE_COLUMNS, "_extra", "_file"])
        return spark.createDataFrame([], f"{text}, _row long")
    # every frame numbers its read partitions from zero; files tell them apart
    return reduce(DataFrame.unionByName, frames)


def read_postings_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S1 over paths: scan, then read."""
    return read_scanned(spark, scan_files(spark, paths).where("problem is null"))


def read_part(row: Column) -> Column:
    """The read partition that a ``_row`` number names."""
    return F.shiftright(row, 33)


def file_segments(rows: DataFrame, file: str) -> DataFrame:
    """(file, read_part, first_row, n, before): the read partitions of each file, ``before`` in rows."""
    parts = rows.groupBy(file, read_part(F.col("_row")).alias("read_part")).agg(
        F.min("_row").alias("first_row"), F.count("*").alias("n"))
    before = Window.partitionBy(file).orderBy("read_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def with_file_positions(rows: DataFrame) -> DataFrame:
    """Dense 0-based row position within each file, in file order (``_pos``).

    The read partitions of the files are one small row each; the planner decides
    from their measured size how they meet the rows.
    """
    segments = file_segments(rows, "_file").select("_file", F.col("read_part").alias("_part"), "first_row", "before")
    return (rows.withColumn("_part", read_part(F.col("_row"))).join(segments, ["_file", "_part"])
            .withColumn("_pos", F.col("before") + F.col("_row") - F.col("first_row"))
            .drop("_part", "first_row", "before"))
