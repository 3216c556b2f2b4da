"""SimHash near-duplicates: fingerprints, pigeonhole blocks, components.

A fingerprint has 64 bits; a bit is set where over half of the shingle hashes
have it.  Two fingerprints link at ``max_bits`` or fewer differing bits.  The 64
bits are cut into ``max_bits + 3`` blocks; a linked pair differs in at most
``max_bits`` of them, so it agrees on some 3 whole blocks.  Each distinct
fingerprint is filed under all choices of 3 blocks (about 32 bits a key with the
defaults), fingerprints that meet under a key are compared by Hamming distance.

Hot keys: equal fingerprints are one row from the start.  A key with more than
``block_rows`` fingerprints is dealt into parts, and every pair of parts is one
bounded group; a group returns a spanning forest of its links (fewer rows than
members), never all its pairs, so no link is lost and no row count is squared.

Defined results: a null text counts as empty; a text without words has
fingerprint zero, which links like any other; rows with a null doc_id get a
fingerprint and the component of it; the component id is the smallest doc_id that
is not null (null if there is none); repeated rows stay and share a component;
columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postline.llm.common import bounded_batches, cut, free_name, named, read_table
from postline.llm.components import components

SEED = 42
BLOCK_ROWS = 2000


def fingerprint(text: bytes, size: int = 3) -> int:
    """The fingerprint of UTF-8 text as an unsigned integer."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    line, gaps = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    first = np.concatenate(([0], gaps[:-1]))
    last = gaps - 1
    n = max(len(words) - size + 1, 1)
    ends = last[size - 1:].tolist() if len(words) >= size else [len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(first[:n].tolist(), ends)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):
        bits = np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint's bits as a signed bigint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), size) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(marks.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), text.alias("text")).mapInArrow(
        run, "doc_id long, text_hash long, fp long")


def block_keys(fp: Column, max_bits: int = 3, agree: int = 3) -> Column:
    """Array of (choice, bits): the fingerprint masked to each choice of ``agree`` blocks."""
    blocks = max_bits + agree
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:]) if a in chosen)
             for chosen in map(set, combinations(edges[:-1], agree))]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("bits"))
                     for i, m in enumerate(signed)])


def _forest(fps: np.ndarray, left: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that connect what the links of a group connect.

    ``left`` marks the first part; where both parts are present only pairs
    across them are looked at, as pairs within a part have a group of their own.
    """
    n = len(fps)
    group = np.arange(n)
    across = left.any() and not left.all()
    right = np.flatnonzero(~left) if across else None
    edges = []
    for i in np.flatnonzero(left) if across else range(n):
        others = right if across else np.arange(i + 1, n)
        close = others[np.bitwise_count(fps[others] ^ fps[i]) <= max_bits]
        # one link to each group that isn't joined yet: n - 1 at most in all
        joined, at = np.unique(group[close], return_index=True)
        new = joined != group[i]
        if new.any():
            edges += [(i, j) for j in close[at[new]].tolist()]
            group[np.isin(group, joined[new])] = group[i]
    return edges


def links(classes: DataFrame, max_bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``max_bits`` of each other.

    ``classes`` has one row per distinct ``fp``.
    """
    keyed = classes.select("fp", F.explode(block_keys(F.col("fp"), max_bits)).alias("k")).select(
        "fp", "k.choice", "k.bits")
    shared = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    met = (keyed.join(shared, ["choice", "bits"])
           .withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int"))
           .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .select("choice", "bits", "fp",
                   F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                   (F.col("part") <= F.col("other")).alias("left")))
    group = ["choice", "bits", "lo", "hi"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None

        def close(frame: pd.DataFrame) -> pd.DataFrame:
            fps = frame["fp"].to_numpy().view(np.uint64)
            left = frame["left"].to_numpy()
            if len(frame) == 0:
                return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
            keys = frame[group].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(keys)]
            out: list[tuple[int, int]] = []
            two = ends - starts == 2  # most groups: one comparison each, all at once
            p = starts[two]
            ok = np.bitwise_count(fps[p] ^ fps[p + 1]) <= max_bits
            pairs = np.stack([p[ok], p[ok] + 1], axis=1)
            for s, e in zip(starts[~two].tolist(), ends[~two].tolist()):
                out += [(s + i, s + j) for i, j in _forest(fps[s:e], left[s:e], max_bits)]
            pairs = np.concatenate([pairs, np.array(out, dtype=np.int64).reshape(-1, 2)])
            signed = frame["fp"].to_numpy()
            return pd.DataFrame({"a": signed[pairs[:, 0]], "b": signed[pairs[:, 1]]})

        for frame in frames:
            frame = frame if kept is None else pd.concat([kept, frame], ignore_index=True)
            keys = frame[group].to_numpy()
            same = (keys == keys[-1]).all(axis=1) if len(keys) else np.array([], bool)
            cut_at = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            kept = frame.iloc[cut_at:].reset_index(drop=True)  # the last group may go on
            yield close(frame.iloc[:cut_at].reset_index(drop=True))
        if kept is not None:
            yield close(kept)

    sorted_met = met.repartition(*group).sortWithinPartitions(*group)
    return sorted_met.mapInPandas(run, "a long, b long")


def _classes(marks: DataFrame, max_bits: int, block_rows: int) -> DataFrame:
    """(fp, first, root): every fingerprint of ``marks``, its smallest doc_id and the name of its component."""
    classes = cut(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes.select("fp"), max_bits, block_rows))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                       max_bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, fp, component_id), a row for each row of ``docs``."""
    marks = cut(fingerprints(docs, id_col, text_col, size).drop("text_hash"), "simhash")
    rooted = _classes(marks, max_bits, block_rows)
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "component_id")
    return marks.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                        max_bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, of those the smallest text hash.

    Decided by row, not by id: where unlike texts share an id, every component still
    keeps one.  Of rows equal in id and text one stays.  Rows with a null id have no
    identity to decide on and stay.
    """
    columns = [named(c) for c in docs.columns]
    mine = [free_name(docs, "_simhash_id"), free_name(docs, "_simhash_text")]
    place = free_name(docs, "_simhash_n")
    marks = cut(fingerprints(docs.where(F.col(id_col).isNotNull()), id_col, text_col, size), "simhash")
    rooted = _classes(marks, max_bits, block_rows).select("fp", "root")
    row = F.struct("doc_id", "text_hash")
    found = marks.groupBy("fp", "doc_id", "text_hash").agg(F.count("*").alias("rows")).join(rooted, "fp")
    found = cut(found.select("root", "doc_id", "text_hash", "rows"), "simhash-rows")
    best = found.groupBy("root").agg(F.min(row).alias("best"), F.count("*").alias("n")).where("n > 1")
    gone = found.join(best, "root").where(row != F.col("best"))
    renamed = lambda rows: rows.select(F.col("doc_id").alias(mine[0]), F.col("text_hash").alias(mine[1]))
    kept = (docs.withColumn(mine[0], F.col(id_col).cast("long")).withColumn(mine[1], F.xxhash64(text_col))
            .join(renamed(gone), mine, "left_anti"))
    equal = found.where("rows > 1")
    if equal.isEmpty():
        return kept.select(*columns)
    order = Window.partitionBy(*mine).orderBy(F.to_json(F.struct(*columns)))
    first = (kept.join(renamed(equal), mine, "left_semi").withColumn(place, F.row_number().over(order))
             .where(named(place) == 1))
    return first.select(*columns).unionByName(kept.join(renamed(equal), mine, "left_anti").select(*columns))
