import hashlib
import random
import zlib

import pytest

from helpers import folder
from postline.llm.merkle import FIELDS, Dag, manifest, op11_merkle_manifest, proofs, ranked

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, tree int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(level, place):
    """(root, sibling digests upwards, the root that another digest at the place leads to) of a list of digests."""
    proof = []
    while len(level) > 1:
        low = place // 16 * 16
        proof.append((level[low:place], level[place + 1:low + 16]))
        level = [sha("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        place //= 16
    return level[0], proof


def brute(rows):
    trees, out = {}, []
    for row in rows:
        trees.setdefault((row[1] is not None, (row[1] or "").encode()), []).append(row)
    names = sorted(trees)
    ordered = {k: sorted(trees[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for k in names}
    digests = {k: [leaf(r) for r in ordered[k]] for k in names}
    subroots = [climb(digests[k], 0)[0] for k in names]
    for i, k in enumerate(names):
        for place, row in enumerate(ordered[k]):
            root, above = climb(subroots, i)
            proof = climb(digests[k], place)[1] + above
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            at = leaf(changed)
            for before, after in proof:
                at = sha("".join([*before, at, *after]))
            text = "".join(d for before, after in proof for d in [*before, *after])
            out.append((row[0], leaf(row), subroots[i], root, sha(text), at, at == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("sources, n", [(1, 1), (1, 16), (1, 17), (3, 40), (40, 700)])
def test_equals_brute_force(spark, tmp_path, sources, n):
    rnd = random.Random(n)
    names = [None, "", *(f"s{chr(233) if k % 3 else 'é́'}{k}" for k in range(sources))][:sources]
    rows = []
    for i in range(n):
        source = names[0] if rnd.random() < 0.4 else rnd.choice(names)
        text = rnd.choice([None, "", "ÄBC word", "x" * 50, "A" * 100_000 if n < 50 else "Abc"])
        rows.append((i * 7, source, rnd.choice([None, "en"]), rnd.choice([None, 5]), text))
    if n > 16:
        rows += [rows[3]] * 40 + [(21, *rows[3][1:4], "other"), (None, *rows[0][1:]), (None, *rows[1][1:])]
    got = op11_merkle_manifest(spark, folder(tmp_path, documents=frame(spark, rows))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)


def test_some_requests_and_empty_table(spark, tmp_path):
    rows = [(i, f"s{i % 2}", "en", 1, f"T{i}") for i in range(300)]
    leaves, trees, top = manifest(frame(spark, rows).select(*FIELDS))
    some = proofs(leaves.where("doc_id % 50 = 0"), trees, top).collect()
    assert sorted(r.doc_id for r in some) == [0, 50, 100, 150, 200, 250]
    assert all(len(r.path) == 3 for r in some) and len({r.root for r in some}) == 1  # 2 levels of 150 leaves, 1 of 2 subroots
    assert op11_merkle_manifest(spark, folder(tmp_path, documents=frame(spark, []))).collect() == []


def test_ranks_over_partitions_and_equal_records(spark):
    rows = spark.range(1000).selectExpr("if(id < 700, 'a', 'b') AS tree", "id % 10 AS k", "id AS digest").repartition(7)
    got = ranked(rows, "tree", "k", "digest").orderBy("tree", "rank").collect()
    assert [r["rank"] for r in got] == [*range(700), *range(300)] and {(r.tree, r.n) for r in got} == {("a", 700), ("b", 300)}
    twins = spark.range(64).selectExpr("'t' AS tree", "id AS rank", "64L AS n", "'d' AS digest")
    dag = Dag(twins)
    assert dag.records[1].count() == 1 and dag.descend(twins.drop("n", "digest")).count() == 64
