import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import docs, folder
from postline.llm.toxicity import Fit, Model, Rows, drop_toxic, fit_model, op1_toxicity, score_docs, word_hashes

QUICK = Fit(steps=60)


def sample(n=240):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(200)]
    out = []
    for i in range(n):
        text = list(rng.choice(words, 40))
        toxic = int(i % 4 == 0)
        if toxic:
            text[rng.integers(40)] = "awful"
        out.append((("en", "de", None)[i % 3], toxic, text))
    return out


def test_learns_a_word_and_scores_in_blocks(monkeypatch):
    model = fit_model([(lang, y, word_hashes(" ".join(text))) for lang, y, text in sample()], QUICK)
    rows = Rows(model.words)
    assert model.score(rows.of("w1 w2 AWFUL w3")) >= 0.5 > model.score(rows.of("w1 w2 w3"))
    long = "w1 " * 5000 + "awful " + "w2 " * 5000
    whole = model.score(rows.of(long))
    monkeypatch.setattr("postline.llm.toxicity.BLOCK_WORDS", 64)
    assert whole == model.score(rows.of(long)) >= 0.5
    assert 0 <= model.score(rows.of("")) < 0.5


def test_without_both_labels_every_score_is_zero():
    for rows in ([], [("en", 1, word_hashes("a"))] * 9):
        assert fit_model(rows, QUICK).score(np.zeros(3, np.int32)) == 0.0


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = op1_toxicity(spark, path).where("held_out").join(labels, "doc_id").collect()
    scores, truth = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    ranks = scores.argsort().argsort()
    n = truth.sum()
    area = (ranks[truth == 1].sum() - n * (n - 1) / 2) / (n * (len(truth) - n))
    assert area > 0.95
    assert ((scores >= 0.5) == truth).mean() > 0.95
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_tables(spark, tmp_path):
    rows = [(i, " ".join(text)) for i, (_, _, text) in enumerate(sample())]
    marks = [(i, 1, y) for i, (_, y, _) in enumerate(sample())] + [(None, 1, 1), (3, None, None), (0, 0, 0), (99_999, 1, 1)]
    extra = [(1000, None), (1001, ""), (None, "w1 awful"), (1, rows[1][1])]
    frame = docs(spark, rows + extra).withColumn("lang", F.when(F.col("doc_id") % 7 != 0, F.col("lang")))
    frame = frame.withColumnRenamed("source", "score").withColumnRenamed("n_chars", "label")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = op1_toxicity(spark, folder(tmp_path, documents=frame, labels=labels)).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert next(r for r in got if r.doc_id is None).predicted == 1 and next(r for r in got if r.doc_id == 1000).predicted == 0
    kept = drop_toxic(frame, labels, QUICK)
    assert kept.columns == frame.columns and 150 < kept.count() < 200
    assert op1_toxicity(spark, folder(tmp_path / "e", documents=frame.limit(0), labels=labels.limit(0))).collect() == []


@pytest.mark.parametrize("lang, toxic", [("en", True), ("de", False), (None, False)])
def test_thresholds_by_language(spark, lang, toxic):
    model = Model(np.zeros(0, np.int64), [np.zeros((1, 1, 1), np.float32)], [np.zeros(1, np.float32)], np.zeros(1, np.float32), 0.0,
                  {"en": 0.4, "de": 0.6})
    model.offset = -0.1  # a score of 0.475
    row = score_docs(docs(spark, [(1, "x")]).withColumn("lang", F.lit(lang).cast("string")), model, keep=["doc_id"]).first()
    assert row.toxic is toxic and abs(row.score - 0.475) < 0.001
