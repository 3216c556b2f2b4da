"""Small tables for the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """``documents`` rows from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS)


def folder(tmp_path, **tables):
    """A folder of Parquet tables, as the registered queries read them."""
    for name, frame in tables.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def scraps(seed, pieces, rows, most):
    """Texts made of random pieces."""
    rnd = random.Random(seed)
    return ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, most))) for _ in range(rows)]
