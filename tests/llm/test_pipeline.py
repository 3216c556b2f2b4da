import random

import corpus_pipeline
from helpers import DOCS, docs, folder
from postline.llm.common import cut, release, scratch_path


def tables(spark, rows, tmp_path):
    bench = spark.createDataFrame([(1, " ".join(f"b{k}" for k in range(20)))], "item_id long, text string")
    labels = spark.createDataFrame([(i, 1, int("awful" in (t or ""))) for i, t in rows if i is not None and i < 400],
                                   "doc_id long, quality int, toxic int")
    return folder(tmp_path, documents=docs(spark, rows), benchmark=bench, labels=labels)


def corpus():
    rnd = random.Random(8)
    words = lambda n: " ".join(f"w{rnd.randrange(900)}" for _ in range(n))
    shared = words(60)
    rows = [(i, words(60) + (" awful" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, rows[1][1]), (1001, "x " + rows[2][1] + "\n" + words(30)), (1002, words(40) + "\n" + shared),
             (1003, shared + "\n" + words(40)), (1004, words(30) + " " + " ".join(f"b{k}" for k in range(20)) + " " + words(30)),
             (1005, None), (1006, ""), (None, "no id but words"), (1007, rows[401 - 400][1])]
    return rows, shared


def test_every_stage_takes_effect(spark, tmp_path):
    rows, shared = corpus()
    path = tables(spark, rows, tmp_path)
    frame = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        frame = cut(stage(spark, frame, path), name)
        kept[name] = frame.collect()
        if name != "sentencepiece":
            assert frame.columns == [f.split()[0] for f in DOCS.split(", ")]
    ids = {name: {r.doc_id for r in rows_} for name, rows_ in kept.items()}
    clean = {i for i, t in rows if i is not None and i % 4 and i < 400}
    assert not ids["toxicity"] & set(range(0, 400, 4)) and clean <= ids["toxicity"]
    texts = {r.doc_id: r.text for r in kept["line_dedup"]}
    assert shared in texts[1002] and shared not in texts[1003] and 1000 not in texts
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept["line_dedup"])
    assert clean <= ids["simhash_near_dedup"] and len(ids["simhash_near_dedup"] & {1005, 1006}) == 1
    assert 1004 not in ids["benchmark_decontamination"] and clean <= ids["benchmark_decontamination"]
    last = corpus_pipeline.run(spark, path).collect()
    assert sorted(map(repr, last)) == sorted(map(repr, kept["sentencepiece"]))


def test_extra_columns_and_empty_tables(spark, tmp_path):
    rows, _ = corpus()
    path = tables(spark, rows, tmp_path)
    wide = spark.read.parquet(f"{path}/documents.parquet").selectExpr(
        "*", "1 AS fp", "'a' AS lines", "map('k', 1) AS h1", "2.0 AS score", "'x' AS words", "array(1) AS item_id")
    for frame in (wide, wide.limit(0)):
        n = frame.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = cut(stage(spark, frame, path), name)
            assert frame.columns == wide.columns
        assert (frame.count() > 0) == (n > 0)


def test_release_deletes_the_written_tables(spark):
    import os
    release(spark)
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    local = path.replace("file:", "", 1)
    assert os.path.exists(local)
    release(spark)
    assert not os.path.exists(local)
