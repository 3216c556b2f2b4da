"""Toxicity: a convolutional text classifier, trained in numpy, scored in Spark tasks.

Words (runs of letters and digits, lower case) hash into a large space; the
hashes seen in several documents of the fitting sample have an embedding, all
others the zero vector.  Filters of several widths slide over the embeddings,
each keeps its maximum over the whole text, and a logistic layer weighs the
maxima.  As filters are linear before the maximum, scoring uses a table with each
word's share at each filter position.

The model is fitted on a bounded sample of labelled rows (``Fit.per_class`` rows
of each label by hash order, of each at most ``Fit.max_chars`` characters); the
sample's ids and words are all that reaches the driver.  Three quarters of it train:
first with the mean of each filter over the text in place of its maximum, so that every
word's embedding moves, then with the maximum.  The rest ends the training and
calibrates: the score is shifted so that 0.5 separates best over all languages, and
every language with calibration rows of both labels gets a threshold of its own, the
nearer to the common one the fewer they are.  Language, source, id and label are
never inputs of a score.

Whole texts are scored in blocks of words with an overlap, so memory is bounded
for a text of any length.  Defined results: a null or empty text scores as a text
without words; a null or unseen language uses the common threshold; a null doc_id
is scored, is not held out and fits nothing; repeated rows are each scored; a doc
with several labels is toxic if one says so; null labels are no labels; without
rows of both labels every score is 0; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from postline.llm.common import bounded_batches, named, read_table

HASH_BITS = 24
WARM_SCALE = 0.3
BLOCK_WORDS = 1 << 16
CACHE_WORDS = 250_000
_WORDS = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit; the first two bound the sample."""

    per_class: int = 4000
    max_chars: int = 20_000
    min_docs: int = 3
    min_share: float = 0.0012
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 6
    size: int = 8
    steps: int = 600
    warm_share: float = 0.3
    check_steps: int = 25
    patience: int = 8
    batch: int = 64
    rate: float = 0.04
    dropout: float = 0.0
    decay: float = 0.0
    shrink: float = 0.3
    floor: float = 2e-3
    false_alarm: float = 3.0
    language_rows: float = 20.0
    seed: int = 11


@dataclass
class Model:
    """What scoring needs: sorted word hashes, a table of filter shares, the last layer, thresholds."""

    words: np.ndarray
    tables: list[np.ndarray] = field(default_factory=list)  # per width: (words + 1, width, filters)
    bias: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, ids: np.ndarray) -> float:
        """The score of a text given as rows of the tables (0: a word that has none)."""
        if self.weights is None:
            return 0.0
        value = float(self.pooled(ids) @ self.weights) + self.offset
        return float(1.0 / (1.0 + np.exp(-np.clip(value, -60, 60))))

    def loss(self, docs: list[np.ndarray], labels: np.ndarray) -> float:
        """The mean logistic loss, both labels with the same weight."""
        value = np.array([float(self.pooled(d) @ self.weights) + self.offset for d in docs])
        each = np.logaddexp(0, np.where(labels == 1, -value, value))
        return float(sum(each[labels == y].mean() for y in (0, 1)))

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        out = []
        for table, bias in zip(self.tables, self.bias):
            width = table.shape[1]
            padded = np.concatenate((ids, np.zeros(width - 1, ids.dtype))) if len(ids) else np.zeros(width, np.int32)
            best = np.full(table.shape[2], -np.inf, dtype=np.float32)
            n = len(padded) - width + 1
            for at in range(0, n, BLOCK_WORDS):
                end = min(at + BLOCK_WORDS, n)
                total = table[padded[at:end], 0]
                for k in range(1, width):
                    total = total + table[padded[at + k:end + k], k]
                best = np.maximum(best, total.max(axis=0))
            out.append(np.maximum(best + bias, 0))
        return np.concatenate(out)


def word_hash(word: str) -> int:
    return zlib.crc32(word.encode()) >> (32 - HASH_BITS)


def word_hashes(text: str) -> np.ndarray:
    """The hash of each word, four bytes a word."""
    found = _WORDS.findall(text.lower())
    return np.fromiter(map(word_hash, found), dtype=np.int32, count=len(found))


class Rows(dict):
    """Word -> its row in the tables, in a bounded cache."""

    def __init__(self, words: np.ndarray):
        super().__init__()
        self.rows = {int(h): i + 1 for i, h in enumerate(words)}

    def __missing__(self, word: str) -> int:
        row = self.rows.get(word_hash(word), 0)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = row
        return row

    def of(self, text: str) -> np.ndarray:
        found = _WORDS.findall(text.lower())
        return np.fromiter(map(self.__getitem__, found), dtype=np.int32, count=len(found))


# --- fitting ------------------------------------------------------------------

class _Network:
    """Embeddings, filters and the logistic layer while they are trained."""

    def __init__(self, n_words: int, fit: Fit):
        rng = np.random.default_rng(fit.seed)
        self.fit, self.rng = fit, rng
        self.embed = rng.normal(0, 0.1, (n_words + 1, fit.size)).astype(np.float32)
        self.embed[0] = 0
        self.filters = [rng.normal(0, 0.5, (w, fit.size, fit.filters)).astype(np.float32) for w in fit.widths]
        self.bias = [np.zeros(fit.filters, np.float32) for _ in fit.widths]
        self.weights = rng.normal(0, 0.3, len(fit.widths) * fit.filters).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.params = [self.embed, *self.filters, *self.bias, self.weights, self.offset]
        self.first = [np.zeros_like(p) for p in self.params]
        self.second = [np.zeros_like(p) for p in self.params]

    def model(self, words: np.ndarray) -> Model:
        tables = [np.stack([self.embed @ f[j] for j in range(len(f))], axis=1) for f in self.filters]
        return Model(words, tables, [b.copy() for b in self.bias], self.weights.copy(), float(self.offset[0]))

    def step(self, docs: list[np.ndarray], labels: np.ndarray, number: int, warm: bool) -> None:
        """One step of Adam on the mean logistic loss of a batch.

        A word that a maximum chose moves with its filter.  While ``warm``, the mean stands in for the
        maximum, so that every word of a text moves a little and the maxima have something to choose.
        """
        fit = self.fit
        n_words = np.array([max(len(d), 1) for d in docs])
        gap = max(fit.widths) - 1  # empty words between texts, so that no filter sees two of them
        starts = np.concatenate(([0], np.cumsum(n_words + gap)[:-1]))
        ids = np.zeros(int((n_words + gap).sum()), np.int64)
        for at, d in zip(starts.tolist(), docs):
            ids[at:at + len(d)] = np.where(self.rng.random(len(d)) < fit.dropout, 0, d)
        inside = np.repeat(np.arange(len(docs)), n_words + gap)
        pooled, chosen = [], []
        vectors = np.concatenate([self.embed[ids], np.zeros((gap, fit.size), np.float32)])
        for f, bias in zip(self.filters, self.bias):
            total = sum(vectors[j:j + len(ids)] @ f[j] for j in range(len(f)))
            if warm:
                pooled.append(WARM_SCALE * np.add.reduceat(total, starts, axis=0) / np.sqrt(n_words)[:, None] + bias)
                continue
            best = np.maximum.reduceat(total, starts, axis=0)
            # the first place of each maximum
            at, column = np.nonzero(total == best[inside])
            place = np.full(best.shape, -1, np.int64)
            place[inside[at[::-1]], column[::-1]] = at[::-1]
            pooled.append(np.maximum(best + bias, 0))
            chosen.append(place)
        hidden = np.concatenate(pooled, axis=1)
        value = hidden @ self.weights + self.offset[0]
        error = ((1.0 / (1.0 + np.exp(-np.clip(value, -60, 60))) - labels) / len(docs)).astype(np.float32)
        back = np.where(warm | (hidden > 0), error[:, None] * self.weights, 0).reshape(len(docs), len(self.filters), fit.filters)
        grads: list[np.ndarray] = [np.zeros(0)]
        bias_grads, rows, moves = [], [], []
        padded = np.concatenate([ids, np.zeros(gap, np.int64)])
        for i, f in enumerate(self.filters):
            g = back[:, i, :]
            own = np.zeros_like(f)
            if warm:
                share = (WARM_SCALE * g / np.sqrt(n_words)[:, None]).astype(np.float32)
                spread = share[inside]
                for j in range(len(f)):
                    own[j] = vectors[j:j + len(ids)].T @ spread
                    rows.append(padded[j:j + len(ids)])
                    moves.append(spread @ f[j].T)
            else:
                for j in range(len(f)):
                    words = padded[chosen[i] + j]                  # documents x filters
                    own[j] = np.einsum("df,dfs->sf", g, self.embed[words])
                    rows.append(words.ravel())
                    moves.append((g[:, :, None] * f[j].T[None]).reshape(-1, fit.size))
            grads.append(own)
            bias_grads.append(g.sum(axis=0))
        grads += [*bias_grads, error @ hidden, np.array([error.sum()], np.float32)]
        touched, where = np.unique(np.concatenate(rows), return_inverse=True)
        moves = np.concatenate(moves)
        moved = np.stack([np.bincount(where, moves[:, c], len(touched)) for c in range(fit.size)], axis=1).astype(np.float32)
        known = touched > 0  # row 0 stands for all other words and stays zero
        self._move(0, touched[known], moved[known], number)
        for k in range(1, len(self.params)):
            self._move(k, slice(None), grads[k], number)

    def _move(self, k: int, rows, g: np.ndarray, number: int) -> None:
        p, m, v, fit = self.params[k], self.first[k], self.second[k], self.fit
        g = g + fit.decay * p[rows]
        m[rows] = 0.9 * m[rows] + 0.1 * g
        v[rows] = 0.999 * v[rows] + 0.001 * g * g
        scale = fit.rate * np.sqrt(1 - 0.999 ** number) / (1 - 0.9 ** number) * min(1.0, 2 - 2 * number / (fit.steps + 1))
        p[rows] = p[rows] * (1 - scale * fit.shrink) - scale * m[rows] / (np.sqrt(v[rows]) + fit.floor)


def _train(docs: list[np.ndarray], labels: np.ndarray, n_words: int, fit: Fit, model: Model,
           check: list[np.ndarray], check_labels: np.ndarray) -> None:
    """Train on batches with as many rows of both labels; ``model`` gets the parameters with the least loss on the check rows."""
    net = _Network(n_words, fit)
    by_label = [np.flatnonzero(labels == y) for y in (0, 1)]
    lowest, since = np.inf, 0
    for number in range(1, fit.steps + 1):
        rows = np.concatenate([net.rng.choice(own, fit.batch // 2) for own in by_label])
        net.step([docs[i] for i in rows], labels[rows], number, number <= fit.warm_share * fit.steps)
        if number > fit.warm_share * fit.steps and (number % fit.check_steps == 0 or number == fit.steps):
            now = net.model(model.words)
            loss = now.loss(check, check_labels)
            if loss < lowest:
                lowest, since = loss, 0
                model.tables, model.bias, model.weights, model.offset = now.tables, now.bias, now.weights, now.offset
            elif (since := since + 1) == fit.patience:
                return


def _cut_point(scores: np.ndarray, labels: np.ndarray, false_alarm: float) -> float:
    """The middle of the widest gap among the cuts with the least error: the share missed and ``false_alarm`` times the other."""
    order = np.argsort(scores, kind="stable")
    s, y = scores[order], labels[order]
    positive, negative = max(y.sum(), 1), max((1 - y).sum(), 1)
    # errors with everything from row i on called toxic
    missed = np.concatenate(([0], np.cumsum(y))) / positive
    false = np.concatenate(([(1 - y).sum()], (1 - y).sum() - np.cumsum(1 - y))) / negative
    low = np.concatenate(([s[0] - 1], s))
    high = np.concatenate((s, [s[-1] + 1]))
    errors = np.where(high > low, missed + false_alarm * false, np.inf)
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    i = best[np.argmax((high - low)[best])]
    return float((low[i] + high[i]) / 2)


def fit_model(sample: list[tuple[str | None, int, np.ndarray]], fit: Fit = Fit()) -> Model:
    """Fit on (language, label, word hashes) rows given in a fixed order."""
    words: dict[int, int] = {}
    hashed = [text for _, _, text in sample]
    calibrate = np.array([i % 4 == 3 for i in range(len(sample))], dtype=bool)
    labels = np.array([y for _, y, _ in sample], dtype=np.int64)
    for h, skip in zip(hashed, calibrate):
        for x in set() if skip else set(h.tolist()):
            words[x] = words.get(x, 0) + 1
    least = max(fit.min_docs, fit.min_share * len(sample))
    known = np.array(sorted(w for w, n in words.items() if n >= least), dtype=np.int64)
    model = Model(known)
    if not len(labels) or min((labels[~calibrate] == y).sum() for y in (0, 1)) == 0:
        return model

    def rows(h: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(h), np.int32)
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        return np.where(known[at] == h, at + 1, 0).astype(np.int32)

    docs = [rows(h) for h in hashed]
    train = np.flatnonzero(~calibrate)
    both = min((labels[calibrate] == y).sum() for y in (0, 1)) >= 3
    held = calibrate if both else np.ones(len(docs), bool)  # too few to hold back: all rows calibrate
    _train([docs[i] for i in train], labels[train], len(known), fit, model,
           [docs[i] for i in np.flatnonzero(held)], labels[held])
    logit = np.array([float(model.pooled(d) @ model.weights) + model.offset for d in docs])
    shift = _cut_point(logit[held], labels[held], fit.false_alarm)
    model.offset -= shift
    languages = [lang for lang, _, _ in sample]
    for lang in sorted({x for x in languages if x is not None}):
        own = held & np.array([x == lang for x in languages])
        rows = min((labels[own] == y).sum() for y in (0, 1))
        if rows:  # the fewer rows, the nearer to the common threshold
            cut = _cut_point(logit[own] - shift, labels[own], fit.false_alarm) * rows / (rows + fit.language_rows)
            model.thresholds[lang] = float(1.0 / (1.0 + np.exp(-np.clip(cut, -60, 60))))
    return model


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> list[tuple[str | None, int, np.ndarray]]:
    """The fitting sample: at most ``per_class`` rows of each label, none held out, longer texts only where shorter ones are too few."""
    marked = (labels.where("doc_id is not null and toxic is not null")
              .where(~_held_out(F.col("doc_id")))
              .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label")))
    texts = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null")
    usable = texts.groupBy("doc_id").agg((F.min(F.length("text")) > fit.max_chars).alias("long"))
    marked = marked.join(usable, "doc_id")
    wanted = None
    for y in (0, 1):
        # bounded by per_class, so the broadcast of both is too
        part = marked.where(F.col("label") == y).orderBy("long", F.xxhash64("doc_id"), "doc_id").limit(fit.per_class)
        wanted = part if wanted is None else wanted.union(part)
    rows = (texts.join(F.broadcast(wanted.select("doc_id", "label")), "doc_id")
            .groupBy("doc_id", "label").agg(F.min(F.struct(F.length("text"), F.substring("text", 1, fit.max_chars).alias("text"), "lang"))
                                            .alias("row"))
            .select("doc_id", "label", "row.text", "row.lang"))
    hashed = [(r.doc_id, r.lang, r.label, word_hashes(r.text)) for r in rows.toLocalIterator()]
    hashed.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()[::-1]), r[0]))
    return [row[1:] for row in hashed]


# --- scoring ------------------------------------------------------------------

def score_docs(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang",
               keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) with score, threshold and toxic (score at or over it)."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's words
    keep = docs.columns if keep is None else keep
    kept = docs.select(*map(named, keep))
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType()), StructField("threshold", DoubleType()),
                         StructField("toxic", BooleanType())])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_tox_text")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows = shared.value, Rows(shared.value.words)
        for batch in batches:
            n = batch.num_columns - 2
            scores = [model.score(rows.of(t.as_py())) for t in batch.column(n)]
            cuts = [model.thresholds.get(x, 0.5) for x in batch.column(n + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(scores, pa.float64()), pa.array(cuts, pa.float64()),
                 pa.array([s >= c for s, c in zip(scores, cuts)], pa.bool_())],
                names=[*keep, "score", "threshold", "toxic"])

    return docs.select(*map(named, keep), text, F.col(lang_col).cast("string").alias("_tox_lang")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), keep: list[str] | None = None) -> DataFrame:
    """Fit on the labelled part of ``docs`` and score all of it."""
    return score_docs(docs, fit_model(sample_of(docs, labels, fit), fit), keep=keep)


def drop_toxic(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that score at or over their language's threshold: no shuffle.

    Only text and language go to Python, a flag comes back.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit_model(sample_of(docs, labels, fit), fit))

    def clean(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model, rows = shared.value, Rows(shared.value.words)
        for texts, langs in columns:
            yield pa.array([model.score(rows.of(t.as_py())) < model.thresholds.get(lang, 0.5)
                            for t, lang in zip(texts, langs.to_pylist())], pa.bool_())

    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    return docs.where(F.arrow_udf(clean, "boolean", ArrowUDFType.SCALAR_ITER)(text, named(lang_col).cast("string")))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text of ``documents``; held-out rows have taught nothing."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = toxicity(docs, read_table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "toxic")
