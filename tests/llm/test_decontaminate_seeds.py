import random
from itertools import combinations

from postline.llm.decontaminate import MASKS, MIN_RATIO, MIN_WORDS, Block, Words, best_stretch, item_masks
from test_decontaminate import text


def test_masks_meet_every_overlap_at_the_threshold():
    """All placements of a fifth replaced words in 12 to 23 words, and in whole shorter items."""
    for n in range(1, 2 * MIN_WORDS):
        looks = [(m, [i for i, on in enumerate(m) if on == "1"]) for m in item_masks(n, MIN_RATIO, MASKS)]
        bits = [sum(1 << (i + k) for i in on) for m, on in looks for k in range(n - len(m) + 1)]
        for gone in combinations(range(n), int((1 - MIN_RATIO) * n + 1e-9)):
            replaced = sum(1 << i for i in gone)
            assert any(not b & replaced for b in bits), (n, gone)


def test_overlaps_equal_all_diagonals():
    rnd = random.Random(4)
    bench = [(k, text(rnd, n, "b")) for k, n in enumerate([5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 20, 40, 60, 100])]
    block, hashes = Block(bench, MASKS, MIN_WORDS, MIN_RATIO), Words()
    periodic = [x if i % 5 != 4 else "new" for i, x in enumerate(bench[-1][1])]
    texts = [text(rnd, 30, "v") + periodic + text(rnd, 30, "v"), []]
    for place in range(1, 11):  # one word of a 12-word item
        texts.append([x if i != place else "new" for i, x in enumerate(bench[7][1])])
    for _ in range(40):
        k, words = rnd.choice(bench)
        copy = [x if rnd.random() > 0.2 else "new" for x in words]
        texts.append(text(rnd, rnd.randint(0, 9), "v") + copy + text(rnd, rnd.randint(0, 9), "v"))
    for words in texts:
        doc = hashes.of(" ".join(words))
        want = {}
        for k, item in enumerate(block.words):
            lengths = [0]
            for offset in range(1 - len(item), len(doc)):
                a, b = max(0, -offset), min(len(item), len(doc) - offset)
                lengths.append(best_stretch(item[a:b] == doc[offset + a:offset + b], MIN_RATIO)[1])
            if max(lengths) >= min(MIN_WORDS, len(item)):
                want[k] = max(lengths)
        assert {k: row[0] for k, row in block.overlaps(doc).items()} == want
    assert block.overlaps(hashes.of(" ".join(texts[0])))[13][0] >= 99
