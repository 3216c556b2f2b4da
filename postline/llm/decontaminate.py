"""Benchmark decontamination by spaced seeds.

Texts are words (runs of letters and digits, lower case).  A fixed mask looks at
some positions of a window and ignores the others, so a window still meets its
copy when the ignored words were replaced.  Every window of a benchmark item and
of a document is hashed under each mask; equal hashes are hits, and each hit is
verified on its diagonal: the words of the item against the words of the document
at that offset.  The best stretch with at least ``min_ratio`` equal words counts,
and a document is contaminated where it reaches ``min_words`` words, or a whole
item that is shorter.  At the fixed threshold no overlap is without a hit: the masks
meet every window of 12 to 23 words with a fifth of them replaced, wherever they are,
and of a longer stretch one half has the share again, down to such a window.  An item
of fewer words gets masks of its own length for the replacements that they miss.

The benchmark is the query set: it is dealt into blocks of at most
``block_words`` words (one longer item is a block of its own) and the documents are
read once per block.  One block at a time is broadcast: where there are several,
what a block finds, or leaves, is written before the next one comes.  One row per
document and item leaves a task, so neither a common word nor a common passage
multiplies rows, and there is no shuffle of texts.  Equal items are searched as one.
An item of fewer than ``WHOLE_WORDS`` words is no passage: only a text that is that
item and nothing else counts.

Defined results: a null or empty text has no hits, nor has an empty item; a null
doc_id is reported as null; rows that repeat an id are one document in the
aggregated result; an empty benchmark finds nothing; ties between items go to the
longer overlap, then the smaller item id; other columns than those named are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from postline.llm.common import bounded_batches, cut, read_table

# Ones are the positions a mask looks at.
MASKS = ("1111011", "110010111", "11000100111")
MIN_WORDS = 12
MIN_RATIO = 0.8
WHOLE_WORDS = 3
BLOCK_WORDS = 1_000_000
CACHE_WORDS = 250_000
SIEVE_BITS = 22
HITS_AT_ONCE = 100_000
_WORDS = re.compile(r"[^\W_]+")


class Words(dict):
    """Word -> 64-bit hash, in a bounded cache."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode())
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value

    def of(self, text: str) -> np.ndarray:
        found = _WORDS.findall(text.lower())
        return np.fromiter(map(self.__getitem__, found), dtype=np.uint64, count=len(found))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window under a mask; empty where the text is shorter than the mask."""
    n = len(words) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.full(n, len(mask) * 1_000_003 + int(mask, 2), dtype=np.uint64)
    for i, on in enumerate(mask):
        if on == "1":
            total = (total ^ words[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    return total


@lru_cache(maxsize=None)
def item_masks(n: int, min_ratio: float, masks: tuple[str, ...]) -> tuple[str, ...]:
    """The masks for an item of n words: a short one has a hit whichever words of it may be replaced."""
    fit = [m for m in masks if len(m) <= n]
    if n >= MIN_WORDS:
        return tuple(fit)
    for gone in combinations(range(n), int((1 - min_ratio) * n + 1e-9)):
        whole = "".join("0" if i in gone else "1" for i in range(n))
        if "1" in whole and not any(
                all(whole[k + i] == "1" for i, on in enumerate(m) if on == "1") for m in fit for k in range(n - len(m) + 1)):
            fit.append(whole)
    return tuple(fit)


def best_stretch(equal: np.ndarray, min_ratio: float) -> tuple[int, int]:
    """Start and length of the longest stretch that begins and ends equal with that share of equal words."""
    # walk of +(1 - r) and -r: a stretch has the share where the walk does not fall over it
    walk = np.concatenate(([0.0], np.cumsum(np.where(equal, 1 - min_ratio, -min_ratio))))
    low = np.minimum.accumulate(walk)
    high = np.maximum.accumulate(walk[::-1])[::-1]
    i = j = start = length = 0
    n = len(equal)
    while i <= n and j <= n:  # two pointers over the running minima and maxima
        if high[j] >= low[i] - 1e-9:
            if j - i > length:
                start, length = i, j - i
            j += 1
        else:
            i += 1
    return start, length


class Block:
    """The seeds of some items: what each hash stands for, and a sieve before the lookup."""

    def __init__(self, items: list[tuple[int, list[str]]], masks: tuple[str, ...], min_words: int, min_ratio: float):
        hashes = Words()
        self.min_words, self.min_ratio = min_words, min_ratio
        self.item_ids = [i for i, _ in items]
        self.words = [np.fromiter((hashes[w] for w in ws), np.uint64, len(ws)) for _, ws in items]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.text = np.concatenate([np.zeros(0, np.uint64), *self.words])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        # what lies around a hit tells only where every overlap is sure to have a hit inside
        self.sure = tuple(masks) == MASKS and min_words >= MIN_WORDS and min_ratio >= MIN_RATIO
        self.least = np.ceil(min_ratio * np.minimum(min_words, sizes) - 1e-9)
        used: set[str] = set()
        keys, owners, places = [], [], []
        for k, words in enumerate(self.words):
            own = item_masks(len(words), min_ratio, tuple(masks)) if len(words) else ()
            used.update(own)
            for mask in own:
                s = seeds(words, mask)
                keys.append(s)
                owners.append(np.full(len(s), k))
                places.append(np.arange(len(s)))
        self.masks = sorted(used)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        keys = join(keys, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = join(owners, np.int64)[order]
        self.places = join(places, np.int64)[order]
        self.sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
        self.sieve[(self.keys >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(item, offset of the item's first word in the text) of the seed hits, in order."""
        found = []
        for mask in self.masks:
            s = seeds(words, mask)
            at = np.flatnonzero(self.sieve[(s >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
            if not len(at):
                continue
            first = np.searchsorted(self.keys, s[at], "left")
            count = np.searchsorted(self.keys, s[at], "right") - first
            upto = np.cumsum(count)
            for low in range(0, int(upto[-1]), HITS_AT_ONCE):
                n = np.arange(low, min(low + HITS_AT_ONCE, int(upto[-1])))
                window = np.searchsorted(upto, n, "right")
                key = first[window] + n - (upto[window] - count[window])
                owner, place, here = self.owners[key], self.places[key], at[window]
                if self.sure:
                    likely = self._around(words, owner, place, here) >= self.least[owner]
                    owner, place, here = owner[likely], place[likely], here[likely]
                found.append(np.unique(np.stack([owner, here - place], axis=1), axis=0))
        return sorted({(k, offset) for part in found for k, offset in part.tolist()})

    def _around(self, words: np.ndarray, owner: np.ndarray, place: np.ndarray, here: np.ndarray) -> np.ndarray:
        """How many words agree near a hit, as far as a window that holds it may reach."""
        at, low, high = self.starts[owner] + place, self.starts[owner], self.ends[owner]
        equal = np.zeros(len(owner), np.int64)
        for step in range(-2 * self.min_words, 2 * self.min_words + 1):
            i, j = at + step, here + step
            inside = (i >= low) & (i < high) & (j >= 0) & (j < len(words))
            equal += inside & (self.text[np.where(inside, i, 0)] == words[np.where(inside, j, 0)])
        return equal

    def overlaps(self, words: np.ndarray) -> dict[int, tuple[int, int, int, int]]:
        """Item number -> (words of the overlap, equal words, its start in the text, its start in the item)."""
        best: dict[int, tuple[int, int, int, int]] = {}
        for k, offset in self.hits(words):
            item = self.words[k]
            if len(item) < WHOLE_WORDS and len(item) != len(words):
                continue
            a, b = max(0, -offset), min(len(item), len(words) - offset)
            equal = item[a:b] == words[offset + a:offset + b]
            start, length = best_stretch(equal, self.min_ratio)
            if length >= min(self.min_words, len(item)) and (k not in best or length > best[k][0]):
                best[k] = (length, int(equal[start:start + length].sum()), offset + a + start, a + start)
        return best


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> DataFrame:
    """(block, item_id, text): distinct items, dealt into blocks of about half the bound at most."""
    items = (benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
             .where("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id")))
    size = F.length("text") / 2 + 1  # no text has more words than that
    total = items.agg(F.sum(size)).first()[0] or 0.0
    blocks = max(1, int(np.ceil(2 * total / block_words)))
    return cut(items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int")), "benchmark")


def _broadcast_blocks(benchmark: DataFrame, item_col: str, block_words: int) -> Iterator[tuple]:
    """(the broadcast items, whether there are more) of each block, one bounded block through the driver at a time."""
    dealt = _blocks(benchmark, item_col, "text", block_words)
    numbers = sorted(r.block for r in dealt.select("block").distinct().collect())
    for number in numbers:
        rows = dealt.where(F.col("block") == number).select("item_id", "text").collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0))
        items = [(r.item_id, _WORDS.findall(r.text.lower())) for r in rows]
        yield benchmark.sparkSession.sparkContext.broadcast(items), len(numbers) > 1


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", min_words: int = MIN_WORDS, min_ratio: float = MIN_RATIO,
             masks: tuple[str, ...] = MASKS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, words, equal_words, doc_word, item_word): the best overlap of each row and item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text(text_col).alias("text"))
    schema = "doc_id long, item_id long, words int, equal_words int, doc_word int, item_word int"
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
    names = ["doc_id", "item_id", "words", "equal_words", "doc_word", "item_word"]

    def search(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, hashes = Block(shared.value, masks, min_words, min_ratio), Words()
            for batch in batches:
                out = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for k, row in block.overlaps(hashes.of(text.as_py())).items():
                        out.append((doc_id, block.item_ids[k], *row))
                columns = list(zip(*out)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        return source.mapInArrow(run, schema)

    found = []
    for shared, several in _broadcast_blocks(benchmark, item_col, block_words):
        rows = search(shared)
        if several:
            rows = cut(rows, "overlaps")
            shared.unpersist()
        found.append(rows)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_items, item_id, words, equal_words): the documents with an overlap and their longest one."""
    found = overlaps(docs, benchmark, **options)
    best = F.max(F.struct("words", "equal_words", (-F.col("item_id")).alias("minus")))
    return (found.groupBy("doc_id").agg(F.countDistinct("item_id").alias("n_items"), best.alias("best"))
            .select("doc_id", "n_items", (-F.col("best.minus")).alias("item_id"), "best.words", "best.equal_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      min_words: int = MIN_WORDS, min_ratio: float = MIN_RATIO, masks: tuple[str, ...] = MASKS,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows whose text holds an overlap: a filter inside each task, no shuffle.

    Only the text goes to Python, a flag comes back.
    """
    bounded_batches(docs.sparkSession)

    def free_of(shared) -> Column:
        def clean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            block, hashes = Block(shared.value, masks, min_words, min_ratio), Words()
            for texts in columns:
                yield pa.array([not block.overlaps(hashes.of(t.as_py())) for t in texts], pa.bool_())

        return F.arrow_udf(clean, "boolean", ArrowUDFType.SCALAR_ITER)(_text(text_col))

    for shared, several in _broadcast_blocks(benchmark, item_col, block_words):
        docs = docs.where(free_of(shared))
        if several:
            docs = cut(docs, "free-of-block")
            shared.unpersist()
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, read_table(spark, sf_dir, "benchmark"))
