import numpy as np
import pytest

from postline.llm.graph_search import nearest


def exact(vectors, q, k=5):
    norms = np.linalg.norm(vectors, axis=1)
    scores = vectors @ vectors[q] / (norms * norms[q])
    scores[q] = -9
    return np.lexsort((np.arange(len(vectors)), -scores))[:k], scores


@pytest.mark.parametrize("shard_nodes", [12_000, 300])
def test_recall_against_brute_force(spark, shard_nodes):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = np.array([r.embedding for r in table.orderBy("vec_id").collect()], float)
    got = {}
    for r in nearest(table, shard_nodes=shard_nodes).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, len(vectors), 50))
    hits = 0
    for q, rows in got.items():
        best, scores = exact(vectors, q)
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        assert all(abs(s - scores[i]) < 1e-12 for _, i, s in rows)
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        hits += len({i for _, i, _ in rows} & set(best.tolist()))
    assert hits / (5 * len(got)) >= 0.95


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (None, [1.0, 1.0]), (50, [0.0, 1.0]), (100, [1.0, 2.0, 3.0]), (7, []), (8, [float("inf"), 1.0])]
    rows += [(200 + k, [1.0, 0.0]) for k in range(1, 40)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = [(r.query_id, r["rank"], r.vec_id) for r in nearest(frame).collect()]
    # of the rows with id 0 the smallest vector counts: (0.5, 0.5)
    assert sorted(got) == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 201), (0, 5, 202),
                           (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 201), (50, 5, 202)]
    assert nearest(frame.limit(0)).collect() == []
