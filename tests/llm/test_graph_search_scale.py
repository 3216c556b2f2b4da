import numpy as np
import pytest

from postline.llm.graph_search import nearest


@pytest.mark.parametrize("scale", [1e-250, 1e200, 2.0 ** -500, 1.0])
def test_components_of_any_size(spark, scale):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(60, 4)) * scale
    vectors[7] *= 1e-50 if scale > 1e-200 else 1.0
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = nearest(rows, every=20).collect()
    exact = vectors / scale
    unit = exact / np.linalg.norm(exact, axis=1, keepdims=True)
    assert len(got) == 15
    for r in got:
        cosines = unit @ unit[r.query_id]
        cosines[r.query_id] = -2
        assert r.vec_id == np.argsort(-cosines)[r["rank"] - 1] and abs(r.score - cosines[r.vec_id]) < 1e-12
