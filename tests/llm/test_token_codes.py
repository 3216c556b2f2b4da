import io
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from helpers import docs, folder, scraps
from postline.llm.token_codes import CodeFile, TextCoder, op3_token_codes, pack_segment, read_codes, write_codes

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", "  ", "   ", "\n", "\t", "\r", "a", "the", "é", "É.", "日本語", "\x00", "😀", "<|endoftext|>", "'s", "'", "in", "ss",
          "\x1c", "\x85", "\u2028", "\xa0", "　", "123", "...", "٣", "ą", "\u200b", "\ufeff", "\u180e", "word,", "(x", "²", "e\u0301."]


def library_ids(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_ids_equal_the_library():
    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        coder = TextCoder(f.read())
    for text in [*scraps(3, PIECES, 4000, 12), "x" * 3000, "word " * 500]:
        assert coder.encode(text) == library_ids(tokenizer, text), text


def test_every_token_and_range_is_addressable():
    rnd = random.Random(3)
    ids = np.array([rnd.choice([0, 5, 255, 256, 50_000, 65_536, 2 ** 31, 70_000]) for _ in range(2000)], np.uint32)
    codes = CodeFile(io.BytesIO(pack_segment([5, None, 9], [1000, 0, 1000], ids)))
    assert [codes.token(i) for i in range(2000)] == ids.tolist()
    for _ in range(60):
        a, b = sorted(rnd.randrange(2001) for _ in range(2))
        assert codes.range(a, b).tolist() == ids[a:b].tolist()
    doc_ids, starts = codes.documents()
    assert doc_ids == [5, None, 9] and starts.tolist() == [0, 1000, 1000, 2000]


def test_tables(spark, tmp_path):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(7, "seven"), (None, "no id"), (3, None), (3, "twice"), (3, "twice"), (1, ""), (2, "long text " * 20_000)]
    frame = docs(spark, rows).withColumnRenamed("lang", "tokens")
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in op3_token_codes(
        spark, folder(tmp_path / "t", documents=frame)).collect())
    assert [r[1] for r in got] == [None, 1, 2, 3, 3, 3, 7]
    at = 0
    texts = {i: [library_ids(tokenizer, t) + bytes(4) for j, t in rows if j == i] for i, _ in rows}
    for start, doc_id, n, crc in got:
        assert start == at and (n, crc) in {(len(b) // 4, zlib.crc32(b)) for b in texts[doc_id]}
        at += n
    small = read_codes(write_codes(frame, PATH, f"{tmp_path}/small", segment_tokens=2)).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in small) == got
    assert read_codes(write_codes(frame.limit(0), PATH, f"{tmp_path}/none")).collect() == []
