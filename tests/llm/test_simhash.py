import random
import re
from collections import Counter, defaultdict

import xxhash

from helpers import docs, folder
from postline.llm.components import components
from postline.llm.simhash import fingerprint, keep_first_of_group, links, op5_simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, bits=3):
    values = sorted(values)
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    groups = defaultdict(set)
    for v in values:
        groups[top(v)].add(v)
    return sorted(map(sorted, groups.values()))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprint_equals_definition():
    for text in ("", " \n", "One", "one TWO", "a b c", "a  b\tc\x0bd É é", "x " * 9000, "\u00a0 a\u2003b c d"):
        assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_components_equal_brute_force(spark, tmp_path):
    rnd = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [[rnd.choice(vocabulary) for _ in range(80)] for _ in range(25)]
    rows = []
    for i in range(160):
        words = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((1000 - i, " ".join(words)))
    rows += [(5000, None), (5001, ""), (None, rows[0][1]), (None, "nobody else says this at all"), (rows[1][0], rows[1][1])]
    got = op5_simhash(spark, folder(tmp_path, documents=docs(spark, rows))).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{brute_fingerprint(t):016x}") for i, t in rows)
    first = {}
    for group in brute_groups({brute_fingerprint(t) for _, t in rows}):
        ids = [i for i, t in rows if brute_fingerprint(t) in group and i is not None]
        first |= {f"{v:016x}": min(ids, default=None) for v in group}
    assert all(r.component_id == first[r.fingerprint] for r in got)


def test_no_link_is_lost_in_hot_keys(spark):
    rnd = random.Random(1)
    values = {rnd.getrandbits(64)}
    while len(values) < 300:
        v = rnd.choice(sorted(values))
        for _ in range(rnd.randint(1, 5)):
            v ^= 1 << rnd.randrange(64)
        values.add(v)
    classes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for block_rows in (2000, 25):
        root = {r.node: r.root for r in components(links(classes, 3, block_rows)).collect()}
        groups = defaultdict(set)
        for v in values:
            groups[root.get(signed(v), signed(v))].add(v)
        assert sorted(map(sorted, groups.values())) == brute_groups(values)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901), (None, 3), (7, 7)], "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(k, 0) for k in range(301)} | {(900, 900), (901, 900)}
    assert components(edges.limit(0)).collect() == []


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = docs(spark, [(3, text), (1, text), (2, "another text entirely here"), (None, text), (2, "another text entirely here")])
    rows = rows.withColumnRenamed("n_chars", "fp")
    kept = keep_first_of_group(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 2), (True, 0)]
    assert keep_first_of_group(rows.limit(0)).collect() == []
