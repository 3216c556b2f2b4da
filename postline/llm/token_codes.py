"""Token ids in directly addressable code files.

Ids are cut into 8-bit chunks, the lowest first.  Level k holds the k-th chunk of
every id that reaches it, a bitmap with a one where the id goes on at level k + 1,
and a rank directory with the number of ones before each 512 bits.  Token i is
read by following its bit: its place on the next level is the rank of its bit.
Nothing is decoded on the way, so any token costs a few small reads.

File layout, little-endian, every section at a multiple of 8 bytes::

    magic "TOKCODE1" | tokens, docs, levels as u64
    per level: entries, chunks at, bitmap at, directory at as u64 (last level: 0, 0)
    doc ids i64[docs] | null marks u8[docs] | token starts u64[docs + 1]
    per level: chunks u8[entries] | bitmap u8[...] | directory u32[...]

Texts are encoded by the tokenizers library and written in ascending doc_id order
(nulls first, then text hash; range partitions, sorted inside), several files a
partition where a partition is large.  Every attempt writes files of its own name
into the shared folder; only those in the manifest, which Spark commits, are
read, so a lost executor or a repeated task leaves no trace in the result.

Words are encoded by the library once per worker while they stay in a bounded
cache: the tokenizer's own split never joins a text across the borders used here
(before a single space, around other white space, between a letter and a sign).
Texts whose only white space is single spaces and line breaks are cut at those,
others by the pattern of the borders.

Defined results: a null text counts as empty (the end id alone); a null doc_id
stays null and comes first; repeated rows are each written; an empty table makes
no files and an empty result; columns other than the two named are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postline.llm.common import Recent, bounded_batches, cut, read_table, scratch_path

MAGIC = b"TOKCODE1"
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 21
CACHE_PARTS = 600_000
CACHE_WORDS = 300_000
END_ID = 0

# The white space of the tokenizer's split pattern.
WHITE = "\t-\r \x85\xa0  -     　"
# Letters of ASCII and Latin-1, and signs that the split never joins to a letter before them.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
SIGNS = '.,;:!?|*#$%&()"'
_CHUNKS = re.compile(f" ?[{LETTERS}]+(?=[{SIGNS}])| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
_WORD = re.compile(f" ?[{LETTERS}]+")
_ODD_WHITE = re.compile(f"[{WHITE}]")
BREAK = "\0"  # stands for a line break at the start of a part


# --- encoding -----------------------------------------------------------------

class OddWhite(Exception):
    """A part holds white space other than single spaces and line breaks."""


class TextCoder:
    """A tokenizer with a bounded cache of words; ids come as little-endian u32 bytes."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges = self.tokenizer.model
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that the alphabet shows as themselves
        self.alphabet = {b: chr(b) for b in plain} | {
            b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.words = Recent(self._encode_chunk, CACHE_WORDS)
        self.parts = Recent(self._encode_part, CACHE_PARTS)

    def _encode_chunk(self, chunk: str) -> bytes:
        if chunk[0] == " " and chunk[1:].isalpha() and chunk.isascii():
            return array("I", [t.id for t in self.merges.tokenize("\u0120" + chunk[1:])]).tobytes()
        if _WORD.fullmatch(chunk):  # one word of the split: straight to the library's merges
            shown = chunk.encode().decode("latin-1").translate(self.alphabet)
            return array("I", [t.id for t in self.merges.tokenize(shown)]).tobytes()
        return self._encode_text(chunk)

    def _encode_text(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode_part(self, part: str) -> bytes:
        """A part after the first of its text: with the space before it, or the line break that it stands after."""
        if part.isalpha() and part.isascii():
            return self.words[" " + part]
        if part[:-1].isalpha() and part.isascii() and part[-1] in SIGNS:
            return self.words[" " + part[:-1]] + self.words[part[-1]]
        if not part or _ODD_WHITE.search(part):
            raise OddWhite
        chunks = ["\n", *_CHUNKS.findall(part[1:])] if part[0] == BREAK else _CHUNKS.findall(" " + part)
        return b"".join(map(self.words.__getitem__, chunks))

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._encode_text(text)
        # longer runs of line breaks, and two before a space or at the end, are one word
        if BREAK not in text and "\n\n\n" not in text and "\n\n " not in text and not text.endswith("\n"):
            first, *parts = text.replace("\n", " " + BREAK).split(" ")
            try:
                rest = b"".join(map(self.parts.__getitem__, parts))
                if first and not _ODD_WHITE.search(first):
                    return b"".join(map(self.words.__getitem__, _CHUNKS.findall(first))) + rest
            except OddWhite:
                pass
        return b"".join(map(self.words.__getitem__, _CHUNKS.findall(text)))


_CODERS: dict[int, TextCoder] = {}


def _coder(model: str, key: int) -> TextCoder:
    """One coder for each worker and model, kept between tasks."""
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = TextCoder(model)
    return _CODERS[key]


# --- the file -----------------------------------------------------------------

def _pad(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """The bytes of one file: documents in order and all their ids one after another."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> 8
        on = more > 0
        last = not on.any()
        ones = np.packbits(on, bitorder="little").tobytes() if not last else b""
        blocks = np.add.reduceat(on, np.arange(0, len(on), RANK_BITS), dtype=np.int64) if not last else []
        ranks = np.concatenate(([0], np.cumsum(blocks))).astype("<u4").tobytes() if not last else b""
        levels.append((len(rest), (rest & 255).astype(np.uint8).tobytes(), ones, ranks))
        if last:
            break
        rest = more[on]
    starts = np.concatenate(([0], np.cumsum(lengths))).astype("<u8")
    sections = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                bytes(d is None for d in doc_ids), starts.tobytes()]
    at = len(MAGIC) + 24 + 32 * len(levels) + sum(len(_pad(s)) for s in sections)
    table = []
    for n, chunks, ones, ranks in levels:
        row = [n]
        for part in (chunks, ones, ranks):
            row.append(at if part else 0)
            at += len(_pad(part))
            sections.append(part)
        table += row
    head = MAGIC + np.array([len(ids), len(doc_ids), len(levels)], "<u8").tobytes() + np.array(table, "<u8").tobytes()
    return b"".join([head, *map(_pad, sections)])


class CodeFile:
    """Reads a file through anything with ``seek`` and ``read``."""

    def __init__(self, source):
        self.source = source
        head = self._read(0, 32)
        if head[:8] != MAGIC:
            raise ValueError("not a token code file")
        self.tokens, self.docs, n = (int(x) for x in np.frombuffer(head[8:], "<u8"))
        self.levels = np.frombuffer(self._read(32, 32 * n), "<u8").reshape(n, 4).astype(np.int64).tolist()
        self.doc_at = 32 + 32 * n
        self.null_at = self.doc_at + 8 * self.docs
        self.start_at = self.null_at + self.docs + (-self.docs % 8)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """The doc ids in order, and the start of each document with the end of the last."""
        ids = np.frombuffer(self._read(self.doc_at, 8 * self.docs), "<i8").tolist()
        nulls = self._read(self.null_at, self.docs)
        starts = np.frombuffer(self._read(self.start_at, 8 * self.docs + 8), "<u8").astype(np.int64)
        return [None if gone else i for i, gone in zip(ids, nulls)], starts

    def _rank(self, level: int, i: int) -> int:
        """Ones before bit i of a level."""
        _, _, bits_at, ranks_at = self.levels[level]
        block = i // RANK_BITS
        before = int(np.frombuffer(self._read(ranks_at + 4 * block, 4), "<u4")[0])
        first, size = block * RANK_BITS // 8, (i % RANK_BITS + 7) // 8
        value = int.from_bytes(self._read(bits_at + first, size), "little")
        return before + (value & ((1 << (i % RANK_BITS)) - 1)).bit_count()

    def token(self, i: int) -> int:
        """Id number i of the file."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level, (_, chunks_at, bits_at, _) in enumerate(self.levels):
            value |= self._read(chunks_at + i, 1)[0] << (8 * level)
            if not bits_at or not self._read(bits_at + i // 8, 1)[0] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def range(self, first: int, end: int) -> np.ndarray:
        """Ids from number ``first`` up to ``end``."""
        out = np.zeros(max(end - first, 0), dtype=np.uint32)
        where, shift = np.arange(len(out)), 0
        for level, (_, chunks_at, bits_at, _) in enumerate(self.levels):
            if end <= first:
                break
            out[where] |= np.frombuffer(self._read(chunks_at + first, end - first), np.uint8).astype(np.uint32) << shift
            if not bits_at:
                break
            a, b = first // 8, (end + 7) // 8
            bits = np.unpackbits(np.frombuffer(self._read(bits_at + a, b - a), np.uint8), bitorder="little")
            on = bits[first - 8 * a:end - 8 * a].astype(bool)
            first = self._rank(level, first)
            end, where, shift = first + int(on.sum()), where[on], shift + 8
        return out


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file named as Spark names it."""
    if "://" not in path:
        path = path.replace("file:", "", 1)
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


# --- Spark --------------------------------------------------------------------

def write_codes(docs: DataFrame, model_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Encode and write all texts under ``folder``; the manifest (part, seq, path, docs, tokens).

    Files follow each other by (part, seq).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(model_path, encoding="utf-8") as f:
        model = f.read()
    shared, key = spark.sparkContext.broadcast(model), zlib.crc32(model.encode())
    target, base = open_store(folder)
    target.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = _coder(shared.value, key), TaskContext.get().partitionId()
        store, root = open_store(folder)
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids: list[int | None] = []
        packed: list[bytes] = []
        size = seq = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(packed), dtype="<u4")
            name = f"{root}/part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.tok"
            with store.open_output_stream(name) as out:
                out.write(pack_segment(doc_ids, [len(p) // 4 for p in packed], ids))
            row = [[part], [seq], [f"{folder}/{name.rsplit('/', 1)[1]}"], [len(doc_ids)], [len(ids)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["part", "seq", "path", "docs", "tokens"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packed.append(coder.encode(text.as_py()) + end)
                doc_ids.append(doc_id)
                size += len(packed[-1]) // 4
                if size >= segment_tokens:
                    yield flush()
                    doc_ids, packed, size, seq = [], [], 0, seq + 1
        if packed:
            yield flush()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
               .withColumn("h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h"))
    manifest = ordered.select("doc_id", "text").mapInArrow(
        run, "part int, seq int, path string, docs long, tokens long")
    return cut(manifest, "token-manifest")


def read_codes(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of a manifest."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))
    files = max(manifest.count(), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                store, name = open_store(path)
                with store.open_input_file(name) as source:
                    codes = CodeFile(source)
                    doc_ids, starts = codes.documents()
                    ids = codes.range(0, codes.tokens).astype("<u4")
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts[:-1] + base), pa.array(np.diff(starts)),
                     pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("path", "base").repartition(files).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of ``documents`` through the files and back."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch_path(spark, "token-codes")
    return read_codes(write_codes(docs, public_tokenizers.path("byte_bpe_50k.json"), folder))
