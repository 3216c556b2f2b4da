import hashlib
import random
import string

import public_tokenizers
import pytest
import sentencepiece

from helpers import docs, folder, scraps
from postline.llm.sentence_pieces import PieceCoder, decode_docs, encode_docs, op10_sentencepiece, read_model

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = [" ", "  ", "   ", "\n", "\t", "\r", "a", "the", "▁", "é", "日本語", "語", "\x00", "😀", "<s>", "in", "ing", "tion", "ss",
          "s", "aaaa", "　", "e\u0301", "---", "====", "...", "0", "00", "123", " " * 17, "ą", "\ufffd", "Ω", "اال", "и", "word.", "A,b"]


@pytest.fixture(scope="module")
def coder():
    return PieceCoder(read_model(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_texts_equal_the_library(coder, library):
    rnd = random.Random(2)
    letters = ["".join(rnd.choice(string.ascii_lowercase[:rnd.randint(1, 26)]) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    for text in [*scraps(3, PIECES, 4000, 14), *letters, "x" * 5000, " " * 3000 + "y", "ab" * 3000]:
        ids = library.encode(text)
        assert coder.encode(text) == ids, text
        assert coder.decode(ids) == library.decode(ids), text


def test_any_ids_decode_as_the_library_does(coder, library):
    rnd = random.Random(6)
    for _ in range(4000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(260), 1, 2, 0, 259, 261, 28705]) for _ in range(rnd.randint(0, 6))]
        assert coder.decode(ids) == library.decode(ids), ids


def test_tables(spark, tmp_path, library):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "same text"), (3, "same text"), (4, "long " * 30_000)]
    frame = docs(spark, rows).withColumnRenamed("lang", "ids")
    got = sorted(map(tuple, op10_sentencepiece(spark, folder(tmp_path, documents=frame)).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want, key=repr)
    encoded = encode_docs(frame, PATH)
    assert sorted((r.text for r in decode_docs(encoded, PATH).collect())) == sorted(t or "" for _, t in rows)
    assert encode_docs(frame.limit(0), PATH).collect() == []
