"""Phrase collocation mining by counting quotient filters.

1. Words are counted per language.  A phrase occurs at most as often as each of its
   words, so only (language, word) pairs with at least ``min_count`` occurrences get
   an id; an id names both, so no key needs a language.
2. Every text is written once as word ids (-1 for any other word and for the end of a
   piece).
3. For 2 to ``longest`` words, each window's ids are packed into one number, which an
   invertible permutation spreads evenly.  Its upper bits are the quotient, the
   rest the full remainder, so a filter's entry names exactly one n-gram.  A filter
   keeps its entries in order with their counts; a remainder is stored in as many bytes
   as it needs, a quotient as the number of its entries or, where there are fewer entries
   than quotients, as the step from the entry before.
   Tasks count into filters of a bounded size; the filters are cut by quotient into
   shards, each shard's filters are merged in order, and the entries with at least
   ``min_count`` are turned back into ids.
4. Longer windows are counted only where both shorter ones are frequent.  That test
   is a Bloom filter of a fixed size: it lets some rare windows through, whose exact
   counts drop them, and never stops a frequent one.
5. Scores compare each phrase with the parts of its cuts, whose counts are all known.

Counts are exact.  The shards grow with the number of words, so a shard's filter has
a bounded size; n-grams are spread by the permutation, so no frequent one makes a
large shard.  Ids are broadcast up to ``BROADCAST_WORDS`` words, beyond that texts get
them by a join.

Defined results: a null text has no words; a null language counts as ``und``; rows
without an id or with a repeated one count like any other; a text without words adds
nothing; an empty table has no rows; other columns are not read.  A text of any
length is read whole; windows reach over the chunks that its ids are stored in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postline.llm.common import bounded_batches, cut, read_table

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
BROADCAST_WORDS = 2_000_000
WORDS_AT_ONCE = 400_000   # distinct words a task counts before it passes them on
KEYS_AT_ONCE = 2_000_000  # windows a task collects before it sorts them into its filter
FILTER_KEYS = 3_000_000   # entries of a task's filter
SHARD_WORDS = 4_000_000   # words of the corpus for each shard
SHARDS_A_TASK = 8         # several small shards a task even out how they are dealt
CHUNK = 1 << 20           # ids of a row
BLOOM_BITS = 26
BUCKETS = 4096

# The signs that end a piece, and the blanks between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANK = b"\t"
_MARK = b"\xff"  # in no UTF-8
_TABLE = bytes(0xFF if b in ENDS else 0x20 if b in BLANK else b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """The words of UTF-8 text with A-Z in lower case, and a mark at the end of each piece."""
    return text.translate(_TABLE).replace(_MARK, b" \xff ").split()


# --- the filter -----------------------------------------------------------------

class Packing:
    """n ids of ``bits`` bits as limbs of up to 64 bits, and the permutation of such numbers."""

    def __init__(self, n: int, bits: int, quotient_bits: int | None = None):
        self.n, self.bits = n, bits
        total = n * bits
        parts = max(2, -(-total // 62))
        self.widths = [total // parts + (i < total % parts) for i in range(parts)]
        first = self.widths[0]
        # the remainder of the first limb in whole bytes, the quotient has what is above them
        wanted = min(first, 16 if quotient_bits is None else quotient_bits)
        self.low_bytes = (first - wanted) // 8
        self.quotient_bits = first - 8 * self.low_bytes
        self.sizes = [self.low_bytes, *(-(-w // 8) for w in self.widths[1:])]

    def pack(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        """Limbs of the numbers whose digits are the columns: each limb takes bits from the top down."""
        limbs, used = [np.zeros(len(columns[0]), np.uint64) for _ in self.widths], 0
        edges = np.cumsum([0, *self.widths])
        for column in columns:
            value = column.astype(np.uint64)
            for k, width in enumerate(self.widths):
                low, high = max(used, edges[k]), min(used + self.bits, edges[k + 1])
                if low < high:
                    piece = (value >> np.uint64(used + self.bits - high)) & np.uint64((1 << int(high - low)) - 1)
                    limbs[k] |= piece << np.uint64(edges[k + 1] - high)
            used += self.bits
        return limbs

    def unpack(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        columns, edges = [], np.cumsum([0, *self.widths])
        for i in range(self.n):
            used, value = i * self.bits, np.zeros(len(limbs[0]), np.uint64)
            for k, limb in enumerate(limbs):
                low, high = max(used, edges[k]), min(used + self.bits, edges[k + 1])
                if low < high:
                    piece = (limb >> np.uint64(edges[k + 1] - high)) & np.uint64((1 << int(high - low)) - 1)
                    value |= piece << np.uint64(used + self.bits - high)
            columns.append(value.astype(np.int64))
        return columns

    def _rounds(self) -> list[tuple[int, int, int]]:
        """(limb that changes, limb it is changed by, key): each step can be undone, as the other limb stays."""
        parts = len(self.widths)
        return [(r % parts, (r + 1) % parts, 0x9E3779B97F4A7C15 * (2 * r + 1) % (1 << 64)) for r in range(3 * parts, 0, -1)]

    def _step(self, limbs: list[np.ndarray], to: int, by: int, key: int) -> None:
        mixed = (limbs[by] ^ (limbs[by] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(key)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        limbs[to] = limbs[to] ^ (mixed >> np.uint64(64 - self.widths[to]))

    def permute(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = list(limbs)
        for step in self._rounds():
            self._step(limbs, *step)
        return limbs

    def restore(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = list(limbs)
        for step in reversed(self._rounds()):
            self._step(limbs, *step)
        return limbs


def _summed(limbs: list[np.ndarray], counts: np.ndarray | None, widths: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct numbers in order with the sums of their counts."""
    n = len(limbs[0])
    if n == 0:
        return limbs, np.zeros(0, np.int64)
    if sum(widths) <= 64 and len(widths) == 2:  # one word each: a sort of plain numbers
        low = np.uint64(widths[1])
        whole = (limbs[0] << low) | limbs[1]
        if counts is None:
            whole.sort()
        else:
            order = np.argsort(whole)
            whole, counts = whole[order], counts[order]
        starts = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
        limbs = [whole[starts] >> low, whole[starts] & np.uint64((1 << widths[1]) - 1)]
    else:
        order = np.lexsort(limbs[::-1])
        limbs, counts = [limb[order] for limb in limbs], None if counts is None else counts[order]
        fresh = np.ones(n, bool)
        fresh[1:] = np.logical_or.reduce([limb[1:] != limb[:-1] for limb in limbs])
        starts = np.flatnonzero(fresh)
        limbs = [limb[starts] for limb in limbs]
    return limbs, (np.diff(np.append(starts, n)) if counts is None else np.add.reduceat(counts, starts)).astype(np.int64)


class QuotientFilter:
    """Counts of permuted numbers, in order; ``cut`` and ``read`` are the stored form."""

    def __init__(self, packing: Packing):
        self.packing = packing
        self.limbs = [np.zeros(0, np.uint64) for _ in packing.widths]
        self.counts = np.zeros(0, np.int64)
        self.waiting: list[tuple[list[np.ndarray], np.ndarray]] = []
        self.held = 0

    def add(self, limbs: list[np.ndarray]) -> None:
        """Count packed numbers."""
        self.merge(*_summed(self.packing.permute(limbs), None, self.packing.widths))

    def merge(self, limbs: list[np.ndarray], counts: np.ndarray) -> None:
        """Take over the entries of another filter; the sorting waits until there are as many as the filter has."""
        self.waiting.append((limbs, counts))
        self.held += len(counts)
        if self.held > max(len(self.counts), KEYS_AT_ONCE):
            self.settle()

    def settle(self) -> QuotientFilter:
        if self.waiting:
            parts = [(self.limbs, self.counts), *self.waiting]
            self.limbs, self.counts = _summed([np.concatenate(limb) for limb in zip(*(p[0] for p in parts))],
                                              np.concatenate([p[1] for p in parts]), self.packing.widths)
            self.waiting, self.held = [], 0
        return self

    def cut(self, shards: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
        """(shard, its first quotient, quotients, remainders, counts): a shard is a range of quotients.

        The quotients are the entries of each, or, below a first quotient of ``~base``, the steps between those of the
        entries, so they never take more than the entries do.
        """
        self.settle()
        low = np.uint64(8 * self.packing.low_bytes)
        quotients = (self.limbs[0] >> low).astype(np.int64)
        size = -(-(1 << self.packing.quotient_bits) // shards)
        edges = np.searchsorted(quotients, np.arange(0, shards + 1) * size)
        for shard, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            base = shard * size
            if int(quotients[b - 1]) - base < b - a:
                runs = np.bincount(quotients[a:b] - base)
            else:
                runs, base = np.diff(quotients[a:b], prepend=base), ~base
            rest = [(self.limbs[0][a:b] & np.uint64((1 << int(low)) - 1)), *(limb[a:b] for limb in self.limbs[1:])]
            stored = [r.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :s] for r, s in zip(rest, self.packing.sizes) if s]
            data = np.concatenate(stored, axis=1).tobytes() if stored else b""
            yield shard, base, runs.astype("<u4").tobytes(), data, self.counts[a:b].astype("<u4").tobytes()

    def read(self, base: int, runs: bytes, data: bytes, counts: bytes) -> None:
        """Merge a stored part."""
        lengths, n = np.frombuffer(runs, "<u4"), len(counts) // 4
        if base < 0:
            quotients = (np.cumsum(lengths, dtype=np.int64) + ~base).astype(np.uint64)
        else:
            quotients = np.repeat(np.arange(len(lengths)) + base, lengths).astype(np.uint64)
        rows, limbs, at = np.frombuffer(data, np.uint8).reshape(n, -1), [], 0
        for size in self.packing.sizes:
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :size] = rows[:, at:at + size]
            limbs.append(wide.reshape(-1).view("<u8").astype(np.uint64))
            at += size
        limbs[0] |= quotients << np.uint64(8 * self.packing.low_bytes)
        self.merge(limbs, np.frombuffer(counts, "<u4").astype(np.int64))


# --- words ------------------------------------------------------------------------

def _sources(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.col(text_col).cast("string").cast("binary").alias("text"))


def count_words(sources: DataFrame) -> DataFrame:
    """(lang, word, f): the occurrences of each word; the row of a null word has those of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [(lang, w, f) for lang, own in seen.items() for w, f in own.items() if w != _MARK]
            rows += [(lang, None, own.total() - own[_MARK]) for lang, own in seen.items()]
            seen.clear()
            columns = list(zip(*rows)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())],
                names=["lang", "word", "f"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = seen.setdefault(lang, Counter())
                size -= len(own)
                own.update(tokens(text.as_py()))
                size += len(own) + 1
                if size > WORDS_AT_ONCE:
                    yield flush()
                    size = 0
        yield flush()

    return (sources.mapInArrow(run, "lang string, word binary, f long")
            .groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("f").alias("f")))


def number_words(frequent: DataFrame) -> DataFrame:
    """``frequent`` (lang, word, f) with ``id``: places inside buckets, so no task sees all words."""
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(BUCKETS))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word")) - 1
    return frequent.withColumn("bucket", bucket).withColumn("id", inside * BUCKETS + F.col("bucket")).drop("bucket")


def encode_texts(sources: DataFrame, words: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(ids): arrays of word ids, -1 for other words, for the ends of pieces and between texts; a text may take several rows.

    A row of a longer text begins with the last ``LONGEST - 1`` ids of the one before, whose
    windows are told apart by ``fresh``, the number of ids in the row that are not such repeats.
    """
    if words.count() <= broadcast_words:
        table: dict[str, dict[bytes, int]] = {}
        for r in words.select("lang", F.col("word").cast("binary").alias("word"), "id").toLocalIterator():
            table.setdefault(r.lang, {})[bytes(r.word)] = r.id
        shared = sources.sparkSession.sparkContext.broadcast(table)  # bounded by broadcast_words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none: dict[bytes, int] = {}
            for batch in batches:
                parts, size = [], 0
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    own = shared.value.get(lang, none).get
                    found = tokens(text.as_py())
                    parts += [np.fromiter((own(w, -1) for w in found), np.int32, len(found)), np.full(1, -1, np.int32)]
                    size += len(found) + 1
                    if size >= CHUNK:
                        yield from rows(parts)
                        parts, size = [], 0
                if parts:
                    yield from rows(parts)

        def rows(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            ids = np.concatenate(parts)
            for at in range(0, len(ids), CHUNK):
                piece = ids[max(at - LONGEST + 1, 0):at + CHUNK]
                fresh = len(ids[at:at + CHUNK])
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(piece)], pa.int32()), pa.array(piece)), pa.array([fresh], pa.int32())],
                    names=["ids", "fresh"])

        return cut(sources.mapInArrow(run, "ids array<int>, fresh int"), "collocation-ids")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = tokens(text)
                for at in range(0, len(found), CHUNK // 16):
                    low = max(at - LONGEST + 1, 0)
                    piece = found[low:at + CHUNK // 16]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(piece)), pa.array([f"{key}/{at}"] * len(piece)), pa.array(range(len(piece)), pa.int32()),
                         pa.array([len(found[at:at + CHUNK // 16])] * len(piece), pa.int32()), pa.array(piece, pa.binary())],
                        names=["lang", "row", "at", "fresh", "word"])

    # too many words to send along: each occurrence meets its id in a join, common words dealt over 64 keys
    salt = F.pmod(F.xxhash64("row"), F.lit(64))
    spread = words.select("lang", "word", "id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint"))).alias("salt"))
    placed = cut(sources.withColumn("key", F.monotonically_increasing_id()).select("lang", F.col("key").cast("string"), "text").mapInArrow(
        split, "lang string, row string, at int, fresh int, word binary"), "collocation-words")
    met = placed.withColumn("word", F.col("word").cast("string")).withColumn("salt", salt).join(spread, ["lang", "word", "salt"], "left")
    return cut(met.groupBy("row", "fresh").agg(F.sort_array(F.collect_list(
        F.struct("at", F.coalesce("id", F.lit(-1)).cast("int").alias("id")))).alias("x")).select(
        F.col("x.id").alias("ids"), "fresh"), "collocation-ids")


# --- phrases ----------------------------------------------------------------------

def _places(limbs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the Bloom filter for each permuted number."""
    mixed = np.zeros(len(limbs[0]), np.uint64)
    for limb in limbs:
        mixed = (mixed ^ limb) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return mixed >> np.uint64(64 - BLOOM_BITS), (mixed * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BLOOM_BITS)


def _windows(ids: np.ndarray, fresh: int, packings: list[Packing], blooms: list[np.ndarray]) -> list[np.ndarray]:
    """Limbs of the windows of ``packings[-1].n`` ids that may be frequent, each window of the text in one row only."""
    n = packings[-1].n
    good = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0)) if len(ids) > 1 else np.zeros(0, np.int64)
    for packing, bloom in zip(packings[:-1], blooms):
        limbs = packing.permute(packing.pack([ids[good + k] for k in range(packing.n)]))
        a, b = _places(limbs)
        one = np.uint64(1)
        inside = ((bloom[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8)) & 1) & (
            (bloom[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1)
        good = good[inside.astype(bool)]
        # a longer window starts where this one and the next place are both good
        good = good[:-1][np.diff(good) == 1] if len(good) else good
    # a window that ends before the fresh ids was counted in the row before
    good = good[(good + n > len(ids) - fresh) & (good + n <= len(ids))]
    return packings[-1].pack([ids[good + k] for k in range(n)])


def count_phrases(encoded: DataFrame, packings: list[Packing], blooms: list, tasks: int, min_count: int) -> DataFrame:
    """(ids, a): the phrases of ``packings[-1].n`` words with at least ``min_count`` occurrences."""
    packing, shards = packings[-1], SHARDS_A_TASK * tasks
    schema = "shard int, base long, runs binary, data binary, counts binary"
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = ["shard", "base", "runs", "data", "counts"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = QuotientFilter(packing), [], 0
        filters = [b.value for b in blooms]

        def flush() -> Iterator[pa.RecordBatch]:
            for part in own.cut(shards):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(part, kinds)], names=names)

        for batch in batches:
            for ids, fresh in zip(batch.column(0), batch.column(1).to_pylist()):
                found = _windows(ids.values.to_numpy(zero_copy_only=False), fresh, packings, filters)
                held.append(found)
                size += len(found[0])
                if size >= KEYS_AT_ONCE:
                    own.add([np.concatenate(limb) for limb in zip(*held)])
                    held, size = [], 0
                    if len(own.settle().counts) >= FILTER_KEYS:
                        yield from flush()
                        own = QuotientFilter(packing)
        if held:
            own.add([np.concatenate(limb) for limb in zip(*held)])
        yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, QuotientFilter] = {}
        for batch in batches:
            for shard, *stored in zip(*(c.to_pylist() for c in batch.columns)):
                whole.setdefault(shard, QuotientFilter(packing)).read(*stored)
        for found in whole.values():
            often = found.settle().counts >= min_count
            columns = packing.unpack(packing.restore([limb[often] for limb in found.limbs]))
            ids = np.stack(columns, axis=1).astype(np.int32).reshape(-1)
            offsets = np.arange(0, len(ids) + 1, packing.n, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(found.counts[often])], names=["ids", "a"])

    parts = encoded.select("ids", "fresh").mapInArrow(count, schema)
    return cut(parts.repartition(tasks, "shard").mapInArrow(merge, "ids array<int>, a long"), "phrases")


def bloom_of(phrases: DataFrame, packing: Packing) -> np.ndarray:
    """A Bloom filter of fixed size, built in slices by tasks of its own address range."""
    slices, slice_bits = 64, BLOOM_BITS - 6

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, packing.n)
            if len(ids):
                at = np.unique(np.concatenate(_places(packing.permute(packing.pack(list(ids.T)))))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at >> slice_bits).astype(np.int32)), pa.array(at)], names=["slice", "at"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number in np.unique(numbers).tolist():
                bits = own.setdefault(number, np.zeros(1 << (slice_bits - 3), np.uint8))
                inside = at[numbers == number] & ((1 << slice_bits) - 1)
                np.bitwise_or.at(bits, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        for number, bits in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([bits.tobytes()])], names=["slice", "bits"])

    rows = (phrases.select("ids").mapInArrow(places, "slice int, at long").repartition("slice")
            .mapInArrow(build, "slice int, bits binary").collect())  # 2 ** (BLOOM_BITS - 3) bytes at most
    bloom = np.zeros((slices, 1 << (slice_bits - 3)), np.uint8)
    for number, bits in rows:
        bloom[number] = np.frombuffer(bits, np.uint8)
    return bloom.reshape(-1)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang",
                  shard_words: int = SHARD_WORDS, broadcast_words: int = BROADCAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """((lang, words, a) of all phrases of 1 to ``longest`` words with ``min_count`` occurrences or more, (lang, n))."""
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"phrases have 1 to {LONGEST} words")
    spark, sources = docs.sparkSession, _sources(docs, text_col, lang_col)
    bounded_batches(spark)
    counted = cut(count_words(sources).where(F.col("word").isNull() | (F.col("f") >= min_count)), "word-counts")
    totals = counted.where("word is null").select("lang", F.col("f").alias("n"))
    words = cut(number_words(counted.where("word is not null")), "word-ids")
    found = [words.select("lang", F.array("word").alias("words"), F.col("f").alias("a"))]
    most = words.agg(F.max("id")).first()[0]
    if most is not None:
        bits = max(int(most).bit_length(), 1)
        tasks = max(1, -(-(totals.agg(F.sum("n")).first()[0] or 0) // shard_words))
        encoded = encode_texts(sources, words, broadcast_words)
        packings, blooms = [], []
        for n in range(2, longest + 1):
            # enough quotients to cut into shards: any more would be empty ones
            packings.append(Packing(n, bits, min(31, 4 + (SHARDS_A_TASK * tasks).bit_length())))
            phrases = count_phrases(encoded, packings, blooms, tasks, min_count)
            if phrases.isEmpty():
                break
            found.append(_worded(phrases, words))
            if n < longest:
                blooms.append(spark.sparkContext.broadcast(bloom_of(phrases, packings[-1])))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return cut(out, "phrase-counts"), totals


def _worded(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, words, a) of (ids, a)."""
    placed = phrases.select("ids", "a", F.posexplode("ids").alias("at", "id"))
    named = placed.join(words.select("id", "lang", "word"), "id")
    return named.groupBy("ids", "a").agg(F.first("lang").alias("lang"), F.sort_array(
        F.collect_list(F.struct("at", "word"))).alias("x")).select("lang", F.col("x.word").alias("words"), "a")


def cut_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in integers of 38 digits."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    above = wide(wide(F.lit(1000), 4) * wide(a, 16) * wide(n, 17), 38)
    return F.call_function("div", above, wide(wide(left, 18) * wide(right, 18), 38))


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, contained_percent: int = 100, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase goes where a longer one that holds it has ``contained_percent`` of its occurrences or more.
    """
    counts, totals = phrase_counts(docs, min_count, **options)
    longer = counts.where(F.size("words") > 1)
    size = F.size("words")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda at: F.slice("words", at, m))))
    held = (longer.where(size > 2).select("lang", F.explode(F.array_distinct(spans)).alias("words"), "a")
            .groupBy("lang", "words").agg(F.max("a").alias("outer")))
    kept = (longer.join(held, ["lang", "words"], "left")
            .where(F.col("outer").isNull() | (F.col("outer") * 100 < F.col("a") * contained_percent)).drop("outer"))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("first"),
        F.slice("words", F.col("k") + 1, size - F.col("k")).alias("rest"))
    part = lambda name, count: counts.select("lang", F.col("words").alias(name), F.col("a").alias(count))
    scored = (cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
              .withColumn("score", cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))))
    lowest = scored.groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each of 32 parts of a language, then the first of those: no task sorts a whole language
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*best)
    lowest = lowest.withColumn("place", F.row_number().over(parts)).where(F.col("place") <= top).drop("place")
    order = Window.partitionBy("lang").orderBy(*best)
    return (lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of ``documents``."""
    return collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, d, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece
  FROM (SELECT *, row_number() OVER () AS d FROM documents WHERE text IS NOT NULL)),
numbered AS (SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM numbered GROUP BY lang),
grams AS ({" UNION ALL ".join(
    f"SELECT lang, {n} AS m, unnest(list_transform(range(1, len(ws) - {n - 2}), lambda i: array_to_string(ws[i:i + {n - 1}], ' '))) AS phrase "
    f"FROM numbered WHERE len(ws) >= {n}" for n in range(1, LONGEST + 1))}),
f AS (SELECT lang, m, phrase, count(*) AS a, string_split(phrase, ' ') AS ws FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
spans AS (
  SELECT lang, a, unnest(list_transform(range(1, len(ws) - s.m + 2), lambda i: array_to_string(ws[i:i + s.m - 1], ' '))) AS phrase
  FROM f CROSS JOIN (SELECT unnest(range(2, {LONGEST})) AS m) s WHERE f.m > s.m),
held AS (SELECT lang, phrase, max(a) AS outer_a FROM spans GROUP BY ALL),
kept AS (SELECT f.* FROM f LEFT JOIN held h USING (lang, phrase) WHERE f.m > 1 AND (outer_a IS NULL OR outer_a < a)),
cuts AS (SELECT k.lang, k.phrase, k.a, c.k, l.a AS l, r.a AS r, n,
    CAST((CAST(1000 AS HUGEINT) * k.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM kept k CROSS JOIN (SELECT unnest(range(1, {LONGEST})) AS k) c
  JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:c.k], ' ')
  JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[c.k + 1:], ' ')
  JOIN total t ON t.lang = k.lang WHERE c.k < k.m),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}
"""
