import random

import numpy as np

from helpers import docs, folder
from postline.llm.decontaminate import best_stretch, contaminated, drop_contaminated, op7_decontaminate, overlaps


def text(rnd, n, kind="w"):
    return [f"{kind}{rnd.randrange(5000)}" for _ in range(n)]


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, words int")


def test_best_stretch_equals_brute_force():
    rnd = random.Random(1)
    for _ in range(1500):
        equal = np.array([rnd.random() < 0.7 for _ in range(rnd.randint(0, 25))], bool)
        most = max([j - i for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)
                    if equal[i:j].sum() >= 0.8 * (j - i) - 1e-9], default=0)
        start, length = best_stretch(equal, 0.8)
        assert length == most and (not length or equal[start:start + length].sum() >= 0.8 * length - 1e-9)


def test_planted_passages_are_found_and_clean_texts_stay(spark, tmp_path):
    rnd = random.Random(2)
    bench = [(k, " ".join(text(rnd, 15 + k)), 0) for k in range(12)] + [(50, "Short, item here!", 0), (51, None, 0), (52, "", 0),
                                                                       (99, "SHORT item here", 0), (None, "null id of four words", 0)]
    rows, dirty = [], set()
    for i in range(60):
        words = text(rnd, 200, "v")
        if i % 3 == 0:
            passage = bench[i % 12][1].split()
            passage[7] = "changed"  # a substitution
            words[40:40] = passage
            dirty.add(i)
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, "a short item here b"), (None, bench[3][1]), (103, bench[4][1]), (103, bench[4][1])]
    dirty |= {102, None, 103}
    frame = docs(spark, rows).withColumnRenamed("lang", "item_id")
    bench = items(spark, bench)
    got = {r.doc_id: r for r in op7_decontaminate(spark, folder(tmp_path, documents=frame, benchmark=bench)).collect()}
    assert set(got) == dirty
    assert got[102].item_id == 50 and got[0].words == 15 and got[0].equal_words == 14
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - dirty
    blocks = overlaps(frame, bench, block_words=40)
    assert sorted(map(repr, blocks.collect())) == sorted(map(repr, overlaps(frame, bench).collect()))
    assert {r.doc_id for r in drop_contaminated(frame, bench, block_words=40).collect()} == {i for i, _ in rows} - dirty


def test_empty_tables(spark):
    frame, bench = docs(spark, [(1, "some text")]), items(spark, [(1, "some text", 0)])
    assert contaminated(frame, bench.limit(0)).collect() == []
    assert contaminated(frame.limit(0), bench).collect() == []
    assert drop_contaminated(frame, bench.limit(0)).count() == 1
