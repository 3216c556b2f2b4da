"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descending it.

Every row is a leaf, the rows of one source are a tree over their leaves in id
order, and the trees' roots (subroots) are the leaves of one tree on top.  Up to
``fan`` consecutive nodes have a parent, whose digest is the hash of theirs; a
level of one node is the root.

A parent is stored as a record ``digest -> children``, by height.  A request names a
leaf by tree and rank.  Written with base ``fan``, the rank's digits are the way
down: the descent starts with the root's digest, looks up its record, follows the
child that the digit names and collects the other children as a path segment.
Requests that share their upper digits share the way there, so a level costs a row
per node on the way and never a row per leaf; only the last step meets the
requests.  The segments, reversed, lead from the leaf to the root: they are the
proof, and folding a leaf's digest along them gives the root.

Ranks come from a range partitioning by (tree, order): the place inside a partition
plus the rows of the partitions before it, so a source with a third of all rows is
many tasks.  All joins are by digest or by (tree, rank); none has a hot key.

Defined results: null columns are hashed as ``-``; a null source is a tree of its
own, the first one; a null doc_id comes first in its tree and is never tampered
with; rows that repeat an id are ordered by their leaf digests, equal rows are
leaves of equal digests; a tree of one leaf is that leaf; an empty table has no
rows and no root; texts of any length are hashed whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postline.llm.common import cut, named, read_table

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest_of(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: list[Column]) -> Column:
    """The hash of the values one after another, each with its length in bytes before it."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return digest_of(F.concat(*map(field, values)))


def ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, inside its tree) and ``n`` (the rows of the tree)."""
    placed = cut(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
                 .withColumn("_at", F.monotonically_increasing_id()), "merkle-ranked")
    part = F.shiftright("_at", 33)  # the id holds the partition above 33 bits of place
    runs = placed.groupBy(part.alias("_part"), tree).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # one row per tree and partition that holds some of it
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", F.col(tree).alias("_tree"), "_first",
                       F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                       F.sum("_rows").over(whole).alias("n"))
    return (placed.join(runs, (part == F.col("_part")) & (F.col(tree) == F.col("_tree")))
            .withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_part", "_tree", "_first", "_before"))


class Dag:
    """The records of some trees by height, and their roots."""

    def __init__(self, leaves: DataFrame, fan: int = FAN):
        """``leaves``: (tree, rank, n, digest), digests as hex text."""
        self.fan = fan
        self.spark = leaves.sparkSession
        level = leaves.select("tree", "rank", "n", "digest")
        most = level.agg(F.max("n")).first()[0] or 0
        self.records: list[DataFrame] = [None]
        roots = [level.where("n = 1").select("tree", "digest", F.lit(0).alias("height"))]
        while most > 1:
            most = -(-most // fan)
            level = cut(
                level.where("n > 1").groupBy("tree", F.floor(F.col("rank") / fan).alias("up"))
                .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("kids"), F.first("n").alias("n"))
                .select("tree", F.col("up").alias("rank"), F.ceil(F.col("n") / fan).alias("n"),
                        F.col("kids.digest").alias("children"))
                .withColumn("digest", digest_of(F.array_join("children", ""))), "merkle-level")
            # content-addressed: equal nodes are one record
            self.records.append(level.select("digest", "children").dropDuplicates(["digest"]))
            roots.append(level.where("n = 1").select("tree", "digest", F.lit(len(self.records) - 1).alias("height")))
        union = roots[0]
        for more in roots[1:]:
            union = union.union(more)
        self.roots = cut(union, "merkle-roots")

    def descend(self, requests: DataFrame, start: DataFrame | None = None) -> DataFrame:
        """``requests`` (tree, rank and others) with ``subroot`` and ``path``, the segments from leaf to root.

        A segment is (before, after): the digests of the other children on both sides.
        ``start`` (tree, above) gives segments from the trees' roots on upwards.
        """
        nothing = F.expr("cast(array() as array<struct<before: string, after: string>>)")
        if start is None:
            roots = self.roots.withColumn("above", nothing)
        else:
            roots = cut(self.roots.join(start.select("tree", "above"), "tree"), "merkle-starts")
        # from the root down, so the segments above come first, reversed
        roots = roots.select("tree", F.lit(0).cast("long").alias("rank"), "digest", F.col("digest").alias("subroot"),
                             F.reverse("above").alias("down"), "height")
        asked = [requests]
        for _ in range(1, len(self.records)):
            asked.append(cut(asked[-1].select("tree", F.floor(F.col("rank") / self.fan).alias("rank")).distinct(), "merkle-asked"))
        at = lambda height: roots.where(F.col("height") == height).drop("height")
        reached = None
        for height in range(len(self.records) - 1, 0, -1):
            here = at(height) if reached is None else reached.unionByName(at(height))
            opened = here.join(self.records[height], "digest").select(
                F.col("tree").alias("_tree"), F.col("rank").alias("_rank"), "children", "subroot", "down")
            below = asked[height - 1]
            digit = F.pmod("rank", F.lit(self.fan)).cast("int")
            side = lambda first, size: F.array_join(F.slice("children", first, size), "")
            segment = F.struct(side(F.lit(1), digit).alias("before"), side(digit + 2, F.lit(self.fan)).alias("after"))
            reached = (below.join(opened, (F.col("tree") == F.col("_tree")) & (F.floor(F.col("rank") / self.fan) == F.col("_rank")))
                       .select(*map(named, below.columns), F.get("children", digit).alias("digest"), "subroot",
                               F.concat("down", F.array(segment)).alias("down")))
        alone = requests.join(at(0).drop("rank"), "tree").select(*map(named, requests.columns), "digest", "subroot", "down")
        reached = alone if reached is None else reached.unionByName(alone)
        return reached.withColumn("path", F.reverse("down")).drop("down")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    return F.aggregate(path, digest, lambda at, s: digest_of(F.concat(s["before"], at, s["after"])))


def proof_text(path: Column) -> Column:
    """All digests of a proof one after another, from the leaf's siblings up."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def leaves_of(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text") -> DataFrame:
    """(doc_id, tree, digest, changed): a leaf per row; ``changed`` is the digest after tampering, null where there is none.

    ``tree`` names the source so that a null one comes first.
    """
    value = lambda c: F.translate(named(c), UPPER, UPPER.lower()) if c == text_col else named(c)
    chosen = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("tree"),
        leaf_digest([named(c) for c in fields]).alias("digest"),
        F.when(chosen, leaf_digest([value(c) for c in fields])).alias("changed"))


def manifest(docs: DataFrame, fan: int = FAN, **columns) -> tuple[DataFrame, Dag, Dag]:
    """(leaves, the DAG of the trees, the DAG of their roots)."""
    # hashed once: the range partitioning reads its input twice
    leaves = cut(ranked(cut(leaves_of(docs, **columns), "merkle-leaves"), "tree", "doc_id", "digest"), "merkle-placed")
    trees = Dag(leaves, fan)
    tops = ranked(trees.roots.withColumn("all", F.lit("")), "all", "tree").select(
        F.col("all").alias("tree"), "rank", "n", "digest", F.col("tree").alias("source_tree"))
    tops = cut(tops, "merkle-tops")
    trees.tops = tops
    return leaves, trees, Dag(tops, fan)


def proofs(leaves: DataFrame, trees: Dag, top: Dag) -> DataFrame:
    """``leaves``, or some of them, with ``subroot``, ``root`` and ``path`` from leaf to root."""
    above = top.descend(trees.tops.select("tree", "rank", "source_tree")).select(
        F.col("source_tree").alias("tree"), F.col("path").alias("above"))
    root = top.roots.first()
    return trees.descend(leaves.withColumnRenamed("digest", "leaf"), above).withColumn(
        "root", F.lit(root.digest if root else None).cast("string"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and proof of every row of ``documents``, and whether the fold of its (tampered) leaf is the root."""
    docs = read_table(spark, sf_dir, "documents").select(*FIELDS)
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    return proofs(*manifest(docs)).select(
        "doc_id", "leaf", "subroot", "root", digest_of(proof_text(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def _oracle(levels: int = 6) -> str:
    """DuckDB: every level as a view over the one below, up to ``levels`` of them for each kind of tree."""
    def value(c: str, text: str) -> str:
        shown = f"CAST({text if c == 'text' else c} AS VARCHAR)"
        return f"coalesce(strlen({shown}) || ':' || {shown}, '-')"
    hashed = lambda text: "sha256(" + " || ".join(value(c, text) for c in FIELDS) + ")"
    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0,0,0,0,0,0,0,0]), lambda x, y: {step})"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda z: CAST(ord(z) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {byte}), 4294967295)"
    sql = [f"""a0 AS (SELECT doc_id, coalesce('s' || source, 'n') AS tree, {hashed('text')} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {hashed(lowered)} END AS changed FROM documents)""",
           """a AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
        count(*) OVER (PARTITION BY tree) AS n FROM a0)""",
           "p0 AS (SELECT tree, r, n, leaf AS d FROM a)"]

    def climb(p: str) -> None:
        for k in range(levels):
            group = f"PARTITION BY tree, r // {FAN} ORDER BY r ROWS BETWEEN"
            sql.append(f"""{p}w{k} AS (SELECT *,
        CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER ({group} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS b,
        CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER ({group} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS f
        FROM {p}{k})""")
            sql.append(f"""{p}{k + 1} AS (SELECT tree, r // {FAN} AS r, (any_value(n) + {FAN - 1}) // {FAN} AS n,
        CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY r)) ELSE any_value(d) END AS d
        FROM {p}{k} GROUP BY tree, r // {FAN})""")

    climb("p")
    sql.append(f"s AS (SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS sr, count(*) OVER () AS n FROM p{levels})")
    sql.append("t0 AS (SELECT '' AS tree, sr AS r, n, subroot AS d FROM s)")
    climb("t")
    sql.append("f0 AS (SELECT a.*, s.subroot, s.sr, coalesce(changed, leaf) AS acc, '' AS proof FROM a JOIN s USING (tree))")
    for i in range(2 * levels):
        p, k, key = ("p", i, "r") if i < levels else ("t", i - levels, "sr")
        tree = "w.tree = f.tree AND" if p == "p" else ""
        sql.append(f"""f{i + 1} AS (SELECT f.* EXCLUDE (acc, proof), f.proof || w.b || w.f AS proof,
        CASE WHEN w.n > 1 THEN sha256(w.b || f.acc || w.f) ELSE f.acc END AS acc
        FROM f{i} f JOIN {p}w{k} w ON {tree} w.r = f.{key} // {FAN ** k})""")
    return ("WITH " + ",\n".join(sql) + f"""
SELECT doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.d AS verified
FROM f{2 * levels} CROSS JOIN t{levels} t""")


ORACLE = _oracle(4)
