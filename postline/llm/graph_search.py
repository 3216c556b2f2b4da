"""Approximate nearest neighbours by robust-pruned directed graphs.

Equal vectors are one node (a map-side window keeps each node's few smallest ids,
more than a result can name), nodes are dealt into shards of bounded size by
hash, and each shard gets a graph: a greedy search from the middle node proposes
neighbours for a node, relaxed pruning drops a proposal that a kept neighbour is
``alpha`` times closer to, back edges are added and pruned alike, in two passes.
Nodes are handled in batches in lockstep.  A query runs a beam search in every
shard, the nodes it ends with are scored exactly in double precision on the
original vectors, and the best of all shards are taken.

Index every row, queries are rows of the table too: a block of queries meets a
shard by an ordinary cogroup of (shard, block), both bounded.  Nearness is the
cosine; ties go to the smaller vec_id.

Defined results: rows with a null id take no part, nor do vectors that are null,
empty, zero or hold a null or non-finite component; of rows that repeat an id the
smallest vector counts; vectors are compared with those of their own length only;
fewer candidates than ``k`` give all of them; an empty table gives an empty
result; columns other than the two named are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postline.llm.common import cut, read_table

SHARD_NODES = 12_000
QUERY_BLOCK = 16_384
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 128
FIRST_LINKS = 6
ALPHA = 1.2
BATCH = 256
WIDE = 4


def beam_search(points: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: none) and squared distances of the ``beam`` nearest found, for all queries in lockstep."""
    b, n = len(queries), len(points)
    seen = np.zeros((b, n + 1), dtype=bool)  # the last column takes the gaps
    ids = np.full((b, beam), -1)
    dist = np.full((b, beam), np.inf, dtype=np.float32)
    spent = np.zeros((b, beam), dtype=bool)
    ids[:, 0] = start
    dist[:, 0] = 2 - 2 * queries @ points[start]
    seen[:, start] = True
    seen[:, n] = True
    while True:
        open_ = (ids >= 0) & ~spent
        turn = np.cumsum(open_, axis=1)
        pick = open_ & (turn <= WIDE)
        live = np.flatnonzero(pick.any(axis=1))
        if not len(live):
            return ids, dist
        spent |= pick
        # the picked nodes first, so that all rows have them in the same columns
        order = np.argsort(~pick[live], axis=1, kind="stable")[:, :WIDE]
        nodes = np.where(np.take_along_axis(pick[live], order, 1), np.take_along_axis(ids[live], order, 1), n)
        near = graph[nodes].reshape(len(live), -1)
        near = np.where(seen[live[:, None], near], n, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        seen[live[:, None], near] = True
        real = near < n
        away = 2 - 2 * np.einsum("brd,bd->br", points[np.minimum(near, n - 1)], queries[live])
        all_ids = np.concatenate((ids[live], np.where(real, near, -1)), axis=1)
        all_dist = np.concatenate((dist[live], np.where(real, away, np.inf)), axis=1)
        all_spent = np.concatenate((spent[live], np.zeros_like(real)), axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[live], dist[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_dist, best, 1)
        spent[live] = np.take_along_axis(all_spent, best, 1)


def robust_prune(points: np.ndarray, owners: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Rows of at most ``degree`` diverse neighbours (padded with len(points)) out of proposals (-1: none)."""
    n = len(points)
    proposed = np.where((proposed == owners[:, None]) | (proposed < 0), n, proposed)
    proposed = np.sort(proposed, axis=1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = n
    real = proposed < n
    vectors = points[np.minimum(proposed, n - 1)]
    to_owner = np.where(real, 2 - 2 * np.einsum("bcd,bd->bc", vectors, points[owners]), np.inf)
    order = np.argsort(to_owner, axis=1, kind="stable")
    proposed, to_owner = np.take_along_axis(proposed, order, 1), np.take_along_axis(to_owner, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    between = 2 - 2 * vectors @ vectors.transpose(0, 2, 1)
    alive = np.isfinite(to_owner)
    kept = np.full((len(owners), degree), n)
    rows = np.arange(len(owners))
    for slot in range(degree):
        if not alive.any():
            break
        first = alive.argmax(axis=1)
        has = alive[rows, first]
        kept[has, slot] = proposed[rows, first][has]
        alive &= ~((alpha * alpha * between[rows, first] <= to_owner) & has[:, None])
        alive[rows, first] = False
    return kept


def _packed(rows: np.ndarray, n: int, degree: int) -> np.ndarray:
    """The ids of each row in its first columns, without repeats, padded with n."""
    rows = np.sort(np.where(rows < 0, n, rows), axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = n
    return np.sort(rows, axis=1)[:, :degree]


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
                seed: int = 5) -> tuple[np.ndarray, int]:
    """Neighbour lists (n + 1 rows, padded with n; the last row is all gaps) and the start node."""
    n = len(points)
    rng = np.random.default_rng(seed)
    graph = np.full((n + 1, degree), n)
    start = int(np.argmax(points @ points.mean(axis=0)))
    if n > 1:
        graph[:n, :FIRST_LINKS] = rng.integers(0, n, (n, FIRST_LINKS))
    for slack in (1.0, alpha):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            batch = order[at:at + BATCH]
            found, _ = beam_search(points, graph, start, points[batch], beam)
            old = np.where(graph[batch] < n, graph[batch], -1)
            kept = robust_prune(points, batch, np.concatenate((found, old), axis=1), degree, slack)
            graph[batch] = kept
            to, who = kept.ravel(), np.repeat(batch, degree)
            to, who = to[to < n], who[to < n]
            near = np.einsum("ed,ed->e", points[to], points[who])
            by = np.lexsort((-near, to))  # the nearest newcomers of a node first
            to, who = to[by], who[by]
            first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, int)
            nodes = to[first]
            place = np.arange(len(to)) - np.repeat(first, np.diff(np.r_[first, len(to)]))
            new = np.full((len(nodes), degree), -1)
            fits = place < degree
            new[np.searchsorted(nodes, to[fits]), place[fits]] = who[fits]
            both = np.concatenate((np.where(graph[nodes] < n, graph[nodes], -1), new), axis=1)
            full = (both >= 0).sum(axis=1) > degree
            graph[nodes[~full]] = _packed(both[~full], n, degree)
            graph[nodes[full]] = robust_prune(points, nodes[full], both[full], degree, slack)
    return graph, start


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, its largest component between 1/2 and 1: the same cosines, and squares in range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _clean(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): the rows that take part, vectors in double precision."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    fine = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return (rows.where("vec_id is not null and vec is not null")
            .where(F.forall("vec", fine) & F.exists("vec", lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")))


def build_index(rows: DataFrame, k: int, shard_nodes: int = SHARD_NODES) -> tuple[DataFrame, int]:
    """(dim, shard, start, vectors, graph, ids) with a row for each shard, and the number of shards.

    ``ids`` has the ``k + 1`` smallest ids of each node: no result can name a later
    one, as all of a node's ids have the same score.
    """
    own = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= k + 1)
    nodes = cut(few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    shards = max(1, math.ceil(nodes.count() / shard_nodes))
    dealt = nodes.withColumns({"dim": F.size("vec"), "shard": F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int")})

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.iloc[np.argsort([i[0] for i in frame["ids"]])]  # the same order whatever arrived first
        vectors = _scaled(np.array(frame["vec"].tolist(), dtype=np.float64))
        graph, start = build_graph(_unit(vectors))
        sizes = [len(i) for i in frame["ids"]]
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "start": [start], "vectors": [vectors.tobytes()],
                             "graph": [graph.astype(np.int32).tobytes()],
                             "ids": [np.concatenate([np.asarray(i, np.int64) for i in frame["ids"]]).tobytes()],
                             "sizes": [np.array(sizes, np.int32).tobytes()]})

    index = dealt.repartition(4 * shards, "dim", "shard").groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, start int, vectors binary, graph binary, ids binary, sizes binary")
    return cut(index, "graphs"), shards


def _search(vectors: np.ndarray, graph: np.ndarray, start: int, ids: np.ndarray, sizes: np.ndarray,
            query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> pd.DataFrame:
    """The ``k`` best rows of a shard for each query, own rows left out."""
    points, ends, queries = _unit(vectors), np.cumsum(sizes), _scaled(queries)
    norms = np.linalg.norm(vectors, axis=1)
    out: list[tuple[int, int, float]] = []
    for at in range(0, len(queries), BATCH):
        part = queries[at:at + BATCH]
        found, _ = beam_search(points, graph, start, _unit(part), beam)
        for q, own, nodes in zip(part, query_ids[at:at + BATCH].tolist(), found):
            nodes = nodes[nodes >= 0]
            scores = (vectors[nodes] * q).sum(axis=1) / (norms[nodes] * np.sqrt((q * q).sum()))
            rows = [(-s, i) for s, x in zip(scores.tolist(), nodes.tolist())
                    for i in ids[ends[x] - sizes[x]:ends[x]].tolist() if i != own]
            out += [(own, i, -s) for s, i in sorted(rows)[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(table: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            beam: int = SEARCH_BEAM, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each row whose id is divisible by ``every``."""
    rows = cut(_clean(table, id_col, vec_col), "vectors")
    index, shards = build_index(rows, k, shard_nodes)
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    queries = (asked.select(F.col("vec_id").alias("query_id"), "vec", F.size("vec").alias("dim"),
                            F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        g = left.iloc[0]
        vectors = np.frombuffer(g["vectors"]).reshape(-1, g["dim"])
        graph = np.frombuffer(g["graph"], np.int32).reshape(len(vectors) + 1, -1)
        return _search(vectors, graph, int(g["start"]), np.frombuffer(g["ids"], np.int64), np.frombuffer(g["sizes"], np.int32),
                       right["query_id"].to_numpy(), np.array(right["vec"].tolist()), k, beam)

    keys, tasks = ["dim", "shard", "block"], 4 * shards * blocks
    found = (graphs.repartition(tasks, *keys).groupBy(*keys)
             .cogroup(queries.repartition(tasks, *keys).groupBy(*keys))
             .applyInPandas(search, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of ``embeddings`` for each row whose id is divisible by 50."""
    return nearest(read_table(spark, sf_dir, "embeddings"))
