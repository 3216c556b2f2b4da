import hashlib
import random
import re
from collections import defaultdict

from helpers import docs, folder
from postline.llm.line_dedup import dedup_lines, op9_line_dedup


def split_words(line):
    return [w for w in re.split("[ \t\r\x0b\x0c\xa0]+", line) if w]


def close(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = max(a, b, key=len), min(a, b, key=len)
    return len(a) == len(b) + 1 and any(a[:j] + a[j + 1:] == b for j in range(len(a)))


def brute(rows, least=8):
    lines = sorted((i, k, tuple(split_words(line))) for i, t in rows if i is not None and t is not None
                   for k, line in enumerate(t.split("\n")) if split_words(line))
    gone, seen, equal = defaultdict(set), [], set()
    for i, k, words in lines:
        if words in equal or (len(words) >= least and any(close(words, w) for w in seen)):
            gone[i].add(k)
        equal.add(words)
        if len(words) >= least:
            seen.append(words)
    return gone


def test_equals_brute_force(spark, tmp_path):
    rnd = random.Random(2)
    vocabulary = ["a", "b", "c", "d"]
    base = [[rnd.choice(vocabulary) for _ in range(8 + k % 4)] for k in range(25)]
    rows = []
    for i in range(180):
        lines = []
        for _ in range(rnd.randint(0, 4)):
            words = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 2)):
                op, p = rnd.randint(0, 2), rnd.randrange(len(words))
                if op == 0:
                    words[p] = rnd.choice([*vocabulary, f"e{rnd.randrange(99)}"])
                elif op == 1:
                    words.insert(p, rnd.choice(vocabulary))
                else:
                    del words[p]
            lines.append(rnd.choice([" ", "  ", "\t", "\xa0 "]).join(words))
        rows.append((i, "\n".join(lines)))
    long = [f"w{k}" for k in range(20_000)]
    rows += [(None, " ".join(base[0])), (1000, None), (1001, ""), (1002, " ".join(base[0]) + "\n"), (1003, " ".join(long)),
             (1004, " ".join(long + ["more"]))]
    gone = brute(rows[:-2])
    gone[1004] = {0}
    frame = docs(spark, rows).withColumnRenamed("lang", "lines").withColumnRenamed("source", "h1")
    got = {r.doc_id: r for r in op9_line_dedup(spark, folder(tmp_path, documents=frame)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        left = t if t is None or not gone.get(i) else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        assert got[i].lines_gone == len(gone.get(i, ())), i
        assert got[i].text_sha256 == (None if left is None else hashlib.sha256(left.encode()).hexdigest()), i
    assert dedup_lines(frame).columns == frame.columns


def test_repeated_rows_and_hot_lines(spark):
    line, family = "one two three four five six seven eight", [f"a b c d e f g h n{k} i" for k in range(300)]
    rows = [(k, line) for k in range(200)] + [(5, line)] + [(1000 + k, x) for k, x in enumerate(family)]
    out = dedup_lines(docs(spark, rows), count_col="lines_gone").collect()
    assert sorted(r.doc_id for r in out if r.text) == [0, 1000]
    assert sum(r.lines_gone for r in out) == 200 + 299


def test_empty_table_and_native_plan(spark, tmp_path):
    frame = docs(spark, [])
    assert dedup_lines(frame).collect() == []
    plan = op9_line_dedup(spark, folder(tmp_path, documents=docs(spark, [(1, "a")])))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
