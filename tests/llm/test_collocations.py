import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import folder
from postline.llm import collocations as col
from postline.llm.collocations import Packing, QuotientFilter, collocations, op13_collocations

SCHEMA = "doc_id long, text string, lang string, word string, id int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, least=100, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                for k in range(len(words) - n + 1):
                    own = counts.setdefault(lang, Counter())
                    own[tuple(words[k:k + n])] += 1
    out = set()
    for lang, f in counts.items():
        n = totals[lang]
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        outer = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for k in range(len(p) - m + 1):
                    outer[p[k:k + m]] = max(outer[p[k:k + m]], a)
        rows_ = []
        for p, a in often.items():
            if 100 * outer[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def corpus(n=400):
    rnd = random.Random(3)
    words = ["a", "b", "C", "é", "É", "der", "zz", "New", "york", "\x00", "x\xa0y", "🙂"]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\x1c", " "]) for _ in range(60))
        rows.append((text + " new York city hall" * (i % 3), rnd.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "en"), (" .\t", None), ("New York city hall " * 30_000, "en")]


@pytest.mark.parametrize("setting", [{}, {"KEYS_AT_ONCE": 500, "FILTER_KEYS": 300, "WORDS_AT_ONCE": 5}])
def test_equals_brute_force(spark, tmp_path, setting):
    rows = corpus()
    options = {"shard_words": 5000} if setting else {}
    old = {k: getattr(col, k) for k in setting}
    try:
        for k, v in setting.items():
            setattr(col, k, v)
        got = collocations(frame(spark, rows), **options).collect()
    finally:
        for k, v in old.items():
            setattr(col, k, v)
    assert set(map(tuple, got)) == brute(rows) and len(got) == len(set(got))


def test_ids_by_join_and_chunks(spark, monkeypatch):
    rows = corpus(200)
    monkeypatch.setattr(col, "CHUNK", 512)
    want = brute(rows, top=40)
    assert set(map(tuple, collocations(frame(spark, rows), top=40).collect())) == want
    assert set(map(tuple, collocations(frame(spark, rows), top=40, broadcast_words=0).collect())) == want


def test_empty_and_rare(spark, tmp_path):
    assert op13_collocations(spark, folder(tmp_path / "e", documents=frame(spark, []))).collect() == []
    assert op13_collocations(spark, folder(tmp_path / "r", documents=frame(spark, [("a b c", "en")] * 99))).collect() == []
    got = op13_collocations(spark, folder(tmp_path / "h", documents=frame(spark, [("a b c", "en")] * 100))).collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b c", 100, 100, 100, 300, 3000)]


@pytest.mark.parametrize("n, bits", [(2, 1), (2, 16), (3, 11), (4, 16), (5, 16), (5, 31), (3, 30)])
def test_filter_is_lossless(n, bits):
    rng = np.random.default_rng(n * bits)
    rows = rng.integers(0, 1 << bits, (500, n))
    rows = np.concatenate([rows, rows[:200], rows[:50]])
    packing = Packing(n, bits)
    whole = QuotientFilter(packing)
    for part in np.array_split(rows, 3):
        one = QuotientFilter(packing)
        one.add(packing.pack(list(part.T)))
        for _, *stored in one.cut(7):
            whole.read(*stored)
    whole.settle()
    back = np.stack(packing.unpack(packing.restore(whole.limbs)), axis=1)
    assert Counter(map(tuple, rows.tolist())) == Counter({tuple(r): c for r, c in zip(back.tolist(), whole.counts.tolist())})


@pytest.mark.parametrize("entries", [1, 40, 70_000])
def test_stored_quotients_take_no_more_than_the_entries(entries):
    rows = np.random.default_rng(entries).integers(0, 1 << 16, (entries, 5))
    packing = Packing(5, 16, 16)
    one, back = QuotientFilter(packing), QuotientFilter(packing)
    one.add(packing.pack(list(rows.T)))
    parts = list(one.cut(8))
    assert sum(len(part[2]) for part in parts) <= 4 * len(one.counts)
    for _, *stored in parts:
        back.read(*stored)
    back.settle()
    assert all((a == b).all() for a, b in zip([*one.limbs, one.counts], [*back.limbs, back.counts]))


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, n, left, right = 9 * 10**14, 9 * 10**15, 10**15, 10**15
    row = spark.range(1).select(col.cut_score(*(F.lit(x).cast("long") for x in (a, n, left, right))).alias("s")).first()
    assert row.s == 1000 * a * n // (left * right)
