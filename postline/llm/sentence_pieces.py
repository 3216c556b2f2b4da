"""SentencePiece BPE encoding and decoding by a table of last tokens.

For each prefix of a text the encoding ends in exactly one token.  An automaton
over the pieces lists the tokens that end at each position; the one that is
compatible with the last token of the prefix before it is stored, and the ids are
read off backwards from the end.  Two tokens are compatible if no merge across
their border would come before the merges that build them.

Runs of the space mark merge last and among themselves, so they are encoded on
their own; characters that no piece holds become byte tokens.  Both end a word,
and words are encoded independently of each other, once per worker while they
stay in a bounded cache.  The digests join what the cache keeps for each part
between spaces: the decimal names of its ids and the bytes they decode to.

The model file is read on the driver by its path; its pieces are broadcast (the
vocabulary's size, whatever the data).  Row-local, no shuffle.  A null text
counts as empty and has no ids; a null doc_id stays null; repeated rows are each
encoded; an empty table gives an empty result; only the two named columns are
read.  Texts of any length are encoded whole, in time linear in their length.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm.common import Recent, bounded_batches, read_table

SPACE = "▁"
NEVER = 1 << 60
CACHE_PARTS = 500_000
CACHE_WORDS = 50_000
CACHE_PAIRS = 600_000
BREAK = "\0"  # stands for a line break at the start of a part


def read_model(path: str) -> dict:
    """Pieces, priorities (0 merges first; equal scores share one) and special ids of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, to_byte, silent, unknown = [], {}, {}, [], None
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        pieces.append(piece)
        if model.is_byte(i):
            to_byte[i] = int(piece[3:5], 16)
        elif model.is_unknown(i):
            unknown = i
        elif model.is_control(i) or model.is_unused(i):
            silent.append(i)
        else:
            scores[i] = model.get_score(i)
    order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
    return {"pieces": pieces, "rank": {i: order[s] for i, s in scores.items()}, "bytes": to_byte,
            "silent": silent, "unknown": unknown}


class SpaceRun(Exception):
    """Two spaces, or a space at an end of a line or text, which a run of space marks encodes."""


class PieceCoder:
    """Encoder and decoder of one model."""

    def __init__(self, model: dict, cache_parts: int = CACHE_PARTS):
        self.pieces = model["pieces"]
        self.rank = {self.pieces[i]: r for i, r in model["rank"].items()}
        self.id_of = {self.pieces[i]: i for i in model["rank"]}
        byte_id = {b: i for i, b in model["bytes"].items()}
        self.byte_ids = [byte_id[b] for b in range(256)]
        self.known = {c for p in self.rank for c in p}
        self._trees()
        self.compatible = Recent(self._compatible, max(CACHE_PAIRS * cache_parts // CACHE_PARTS, 1))
        self.words = Recent(self._segment, CACHE_WORDS)
        self.parts = Recent(self._part, cache_parts)
        self.breaks_end_words = "\n" not in self.known
        self.split = re.compile(self._borders()).findall
        self.lengths = [len(p) for p in self.pieces]
        self.raw = [b""] * len(self.pieces)
        for p, i in self.id_of.items():
            self.raw[i] = p.replace(SPACE, " ").encode()
        for i, b in model["bytes"].items():
            self.raw[i] = bytes([b])
        if model["unknown"] is not None:
            self.raw[model["unknown"]] = " ⁇ ".encode()
        self.silent = frozenset(model["silent"])
        self.is_byte = frozenset(model["bytes"])
        self.names = [str(i) for i in range(len(self.pieces))]

    def _borders(self) -> str:
        """A pattern that cuts marked text only where no piece can reach across.

        Those places are: before a run of space marks, around a character that no
        piece holds, and between a letter and a sign that follows a letter in no piece.
        """
        stops = "".join(c for c in "\n\t" if c not in self.known)
        glued = {p[i + 1] for p in self.rank for i in range(len(p) - 1) if p[i].isalpha()}
        signs = "".join(re.escape(c) for c in ",.!?|:;" if c not in glued)
        word = f"{SPACE}*[^\\W\\d_]+(?=[{signs}])|" if signs else ""
        return f"{word}{SPACE}+[^{SPACE}{stops}]*|[^{SPACE}{stops}]+" + (f"|[{stops}]" if stops else "")

    def _merge(self, symbols: list[str]) -> tuple[list[str], dict[str, tuple[str, str]]]:
        """Merge by priority, then leftmost; the symbols that stay and the halves of each merged one."""
        text, after, before = list(symbols), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        halves: dict[str, tuple[str, str]] = {}
        heap: list[tuple[int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(text) and (r := self.rank.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (r, i, text[i] + text[j]))

        for i in range(len(text) - 1):
            offer(i)
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = after[i]
            if not text[i] or j >= len(text) or text[i] + text[j] != whole:
                continue
            halves[whole] = (text[i], text[j])
            text[i], text[j] = whole, ""
            after[i] = after[j]
            if after[j] < len(text):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [t for t in text if t], halves

    def _trees(self) -> None:
        """How each piece is built, the edges of its tree, and the automaton of all reachable pieces."""
        halves: dict[str, tuple[str, str]] = {}
        reachable = []
        for piece in self.rank:
            if len(piece) > 1 and not piece.strip(SPACE):
                continue
            if SPACE in piece[1:]:
                raise ValueError(f"a space mark inside a piece isn't supported: {piece!r}")
            if len(piece) == 1:
                reachable.append(piece)
                continue
            rest, built = self._merge(list(piece))
            if len(rest) == 1:
                reachable.append(piece)
                halves[piece] = built[piece]
        if missing := self.known - self.rank.keys():
            raise ValueError(f"characters without a piece of their own aren't supported: {sorted(missing)[:5]}")
        ranks = [self.rank[p] for p in reachable]
        if len(set(ranks)) < len(ranks):
            raise ValueError("pieces of equal score aren't supported")
        for whole, (a, b) in halves.items():
            if any(len(x) > 1 and self.rank[x] > self.rank[whole] for x in (a, b)):
                raise ValueError(f"a piece that merges before its parts isn't supported: {whole!r}")
        self.right: dict[int, list[tuple[str, int]]] = {}
        self.left: dict[int, list[tuple[str, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in reachable:
            for side, edges in ((1, self.right), (0, self.left)):
                spine = [piece]
                while spine[-1] in halves:
                    spine.append(halves[spine[-1]][side])
                # from the character at the border up: (symbol, when it becomes the next one)
                up = spine[::-1]
                edges[self.id_of[piece]] = [(s, self.rank[up[k + 1]] if k + 1 < len(up) else NEVER)
                                            for k, s in enumerate(up)]
            self.automaton.add_word(piece, (self.id_of[piece], len(piece)))
        self.automaton.make_automaton()

    def _compatible(self, pair: int) -> bool:
        """Whether the first token of ``first * vocabulary + second`` may stand before the second."""
        first, second = divmod(pair, len(self.pieces))
        left, right, rank = self.right[first], self.left[second], self.rank
        i = j = 0
        while True:
            (a, grow_a), (b, grow_b) = left[i], right[j]
            across = rank.get(a + b)
            # of equal merges the leftmost comes first: the left token's own, the one across, the right token's own
            if across is not None and across < grow_a and across <= grow_b:
                return False
            if grow_a == NEVER and grow_b == NEVER:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1

    def _word(self, word: str) -> list[int]:
        """Ids of a word of known characters with a space mark at its start at most."""
        size, compatible = len(self.pieces), self.compatible
        last: list[int | None] = [None] * len(word)  # the last token of the prefix that ends here
        for end, (token, length) in self.automaton.iter(word):
            if last[end] is None and (end < length or compatible[last[end - length] * size + token]):
                last[end] = token
        ids, at, lengths = [], len(word) - 1, self.lengths
        while at >= 0:
            token = last[at]
            ids.append(token)
            at -= lengths[token]
        ids.reverse()
        return ids

    def _plain(self, text: str) -> list[int]:
        if self.known.issuperset(text):
            return self._word(text)
        ids: list[int] = []
        first = 0
        for i, c in enumerate(text):
            if c not in self.known:
                ids += self._word(text[first:i])
                ids += [self.byte_ids[b] for b in c.encode("utf-8")]
                first = i + 1
        return ids + self._word(text[first:])

    def _segment(self, text: str) -> list[int]:
        body = text.lstrip(SPACE)
        marks = len(text) - len(body)
        if marks < 2:
            return self._plain(text)
        ids = self._plain(SPACE + body) if body else []
        alone = not ids or ids[0] == self.id_of[SPACE]
        run = self._merge([SPACE] * (marks if alone else marks - 1))[0]
        return [self.id_of[p] for p in run] + (ids[1:] if alone else ids)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.words.__getitem__, self.split(SPACE + text.replace(" ", SPACE)))))

    def _part(self, part: str) -> tuple[str, bytes]:
        """(the names of the ids, the bytes they decode to) of what follows a space, or a line break in its place."""
        if not part:
            raise SpaceRun
        marked = "\n" + part[1:] if part[0] == BREAK else SPACE + part
        ids = list(chain.from_iterable(map(self.words.__getitem__, self.split(marked))))
        return ",".join(map(self.names.__getitem__, ids)), b"".join(map(self.raw.__getitem__, ids))

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """(number of ids, their decimal names joined by commas, the text that they decode to)."""
        if text and BREAK not in text and SPACE not in text and self.breaks_end_words:
            try:  # parts between single spaces are words or several
                names, raw = zip(*map(self.parts.__getitem__, text.replace("\n", " " + BREAK).split(" ")))
                ids, whole = ",".join(names), b"".join(raw)
                return ids.count(",") + 1, ids, (whole[1:] if whole[:1] == b" " else whole).decode("utf-8")
            except (SpaceRun, UnicodeDecodeError):
                pass
        ids = self.encode(text)
        return len(ids), ",".join(map(self.names.__getitem__, ids)), self.decode(ids)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: bytes in a row are read as UTF-8, each broken one becomes U+FFFD."""
        if not self.silent.isdisjoint(ids):
            return self._decode_broken(ids)
        whole = b"".join(map(self.raw.__getitem__, ids))
        if ids and self.pieces[ids[0]].startswith(SPACE):
            whole = whole[1:]
        try:
            return whole.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids: list[int]) -> str:
        out, at, first = [], 0, True
        while at < len(ids):
            if ids[at] not in self.is_byte:
                piece = self.raw[ids[at]].decode("utf-8")
                out.append(piece[1:] if first and self.pieces[ids[at]].startswith(SPACE) else piece)
                first = first and ids[at] in self.silent
                at += 1
                continue
            first = False
            end = at
            while end < len(ids) and ids[end] in self.is_byte:
                end += 1
            run = b"".join(map(self.raw.__getitem__, ids[at:end]))
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                run = run[n:]
            at = end
        return "".join(out)


_CODERS: dict[int, PieceCoder] = {}


def _coder(shared) -> PieceCoder:
    """One coder for each worker and model."""
    key = shared.value["key"]
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = PieceCoder(shared.value, shared.value["cache"])
    return _CODERS[key]


def _share(spark: SparkSession, model_path: str, cache_parts: int = CACHE_PARTS):
    bounded_batches(spark)
    model = read_model(model_path)
    model["cache"] = cache_parts
    model["key"] = hashlib.sha256(repr(sorted(model["rank"].items())).encode() + repr(model["pieces"]).encode()).hexdigest()
    return spark.sparkContext.broadcast(model)


def encode_docs(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each text, without begin and end ids."""
    shared = _share(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            ids = [coder.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>")


def decode_docs(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text of each id list; a null list gives an empty text."""
    shared = _share(encoded.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            texts = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                       cache_parts: int = CACHE_PARTS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass over the rows.

    ``cache_parts`` bounds a worker's cache: about 450 bytes each, time against memory.
    """
    shared = _share(docs.sparkSession, model_path, cache_parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                count, names, decoded = coder.round_trip(text.as_py() or "")
                counts.append(count)
                ids_sha.append(sha(names.encode()))
                text_sha.append(sha(decoded.encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text of ``documents`` and the text they decode to, as digests."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))
