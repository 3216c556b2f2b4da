import numpy as np

from helpers import docs
from postline.llm.toxicity import Fit, Model, Rows, fit_model, sample_of, word_hashes
from test_toxicity import sample


def rows_of(n=600):
    """Texts whose last words tell: "not" before "good" is toxic, either alone is not."""
    rng = np.random.default_rng(5)
    out = []
    for i in range(n):
        words = list(rng.choice([f"w{k}" for k in range(80)], 30))
        at = int(rng.integers(28))
        words[at:at + 2] = [("not", "good"), ("good", "not"), ("not", "w1"), ("w2", "good")][i % 4]
        out.append(("en", int(i % 4 == 0), words))
    return out


def area(model, rows):
    table = Rows(model.words)
    scores = np.array([model.score(table.of(" ".join(text))) for _, _, text in rows])
    truth = np.array([y for _, y, _ in rows])
    toxic, clean = scores[truth == 1], scores[truth == 0]
    return ((toxic[:, None] > clean) + 0.5 * (toxic[:, None] == clean)).mean()


def test_training_beats_the_start():
    rows = sample(480)
    train = [(lang, y, word_hashes(" ".join(text))) for lang, y, text in rows[:320]]
    trained, start = fit_model(train), fit_model(train, Fit(steps=1, warm_share=0.0, rate=0.0))
    assert area(trained, rows[320:]) > 0.99 and area(start, rows[320:]) < 0.8


def test_wider_filters_learn_an_order():
    rows = rows_of()
    train = [(lang, y, word_hashes(" ".join(text))) for lang, y, text in rows[:450]]
    wide, narrow = (area(fit_model(train, Fit(widths=w, filters=12)), rows[450:]) for w in ((2, 3), (1,)))
    assert wide > 0.8 and wide > narrow


def test_pooled_equals_a_naive_convolution():
    rng = np.random.default_rng(2)
    embed, filters = rng.normal(size=(40, 5)), [rng.normal(size=(w, 5, 4)) for w in (1, 2, 3)]
    bias = [rng.normal(size=4) for _ in filters]
    tables = [np.stack([embed @ f[j] for j in range(len(f))], axis=1) for f in filters]
    for n in (0, 1, 2, 7, 50):
        ids = rng.integers(0, 40, n)
        want = []
        for f, b in zip(filters, bias):
            padded = list(ids) + [0] * (len(f) - 1 if n else len(f))
            windows = [sum(embed[padded[i + j]] @ f[j] for j in range(len(f))) for i in range(len(padded) - len(f) + 1)]
            want += np.maximum(np.max(windows, axis=0) + b, 0).tolist()
        got = Model(np.arange(39), tables, bias, np.ones(12)).pooled(np.asarray(ids, np.int32))
        assert np.allclose(got, want, atol=1e-5)


def test_every_language_with_both_labels_has_a_threshold():
    model = fit_model([(lang, y, word_hashes(" ".join(text))) for lang, y, text in sample(480)])
    assert set(model.thresholds) == {"en", "de"} and all(0 < t < 1 for t in model.thresholds.values())


def test_unusable_rows_do_not_use_up_the_sample(spark):
    rows = [(i, "short text") for i in range(30)] + [(i, "long " * 50) for i in range(30, 60)] + [(i, None) for i in range(60, 90)]
    marks = [(i, 1, int(i >= 30)) for i in range(200)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = sample_of(docs(spark, rows), labels, Fit(per_class=5, max_chars=20))
    assert sorted(y for _, y, _ in got) == [0] * 5 + [1] * 5
    assert all(len(words) == (4 if y else 2) for _, y, words in got)
