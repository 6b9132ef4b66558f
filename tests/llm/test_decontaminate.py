import random

import numpy as np
import pytest

from quorum.llm.decontaminate import Items, budget, contaminated, folded, grams
from tests.llm.helpers import docs, prose


def least_edits(item, text):
    """Least edit distance between the item and any part of the text (plain table)."""
    a, b = folded(item)[1], folded(text)[1]
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def damaged(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + rng.choice("xyzé語") + text[at:], text[:at] + text[at + 1:],
                           text[:at] + rng.choice("xyz ") + text[at + 1:]])
    return text


def test_finds_exactly_what_brute_force_finds():
    rng = random.Random(5)
    items = [(i, " ".join(prose(rng, rng.randrange(4, 45), 60))) for i in range(14)]
    items += [(20, "Été ÀÉ 語 " * 6), (21, "tiny"), (22, "short item here"), (23, "ab" * 40), (24, "語語語語語語語語語語"), (25, "é語")]
    texts = []
    for _ in range(160):
        i, item = rng.choice(items)
        k = budget(len(item))
        part = damaged(rng, item, rng.randrange(0, k + 3))
        texts.append(" ".join(prose(rng, rng.randrange(0, 30), 60)) + rng.choice([" ", ""]) + rng.choice([part, part.upper(), part.replace(" ", "\n")])
                     + " " + " ".join(prose(rng, rng.randrange(0, 30), 60)))
    texts += ["", "   ", items[0][1][:40], "ab" * 300, "x" * 5000]
    index = Items(items)
    hits = 0
    for text in texts:
        got = {}
        for i, start, end, edits in index.find(text):
            got[i] = min(edits, got.get(i, 99))
            assert least_edits(dict(items)[i], text[start:end]) == edits
        want = {i: d for i, item in items if (d := least_edits(item, text) if text else 99) <= budget(len(item))}
        assert got == want, text
        hits += len(want)
    assert hits > 60


def test_grams_of_every_position():
    codes = np.frombuffer(bytes(range(1, 60)), dtype=np.uint8)
    assert grams(codes).tolist() == [int.from_bytes(bytes(range(i + 1, i + 9)), "little") for i in range(52)]
    assert len(grams(codes[:7])) == 0 and len(grams(codes[:8])) == 1 and len(grams(codes[:13])) == 6


@pytest.mark.parametrize("block_chars", [1 << 20, 150])
def test_operator(spark, block_chars):
    rng = random.Random(6)
    items = [(i, " ".join(prose(rng, 30, 500))) for i in range(8)]
    bench = spark.createDataFrame([*items, (3, items[3][1]), (90, None), (91, ""), (92, "  \n"), (None, items[5][1])],
                                  "item_id long, text string").selectExpr("*", "1 as id", "2 as matches")
    rows = [(1, "before " + items[3][1] + " after"), (2, items[5][1].upper()), (3, None), (4, ""), (None, items[0][1]),
            (5, " ".join(prose(rng, 4000, 500)) + items[7][1] + " tail" * 100_000), (6, "clean"), (6, "clean"),
            (7, items[1][1] + " x " + items[2][1])]
    df = docs(spark, rows).selectExpr("*", "1 as item_id", "'m' as matches")
    got = contaminated(df, bench, carry=("lang",), block_chars=block_chars).collect()
    found = sorted(((r.id, sorted({m.item_id for m in r.matches}, key=str)) for r in got), key=str)
    assert found == sorted([(1, [3]), (2, [5, None]), (3, []), (4, []), (None, [0]), (5, [7]), (6, []), (6, []), (7, [1, 2])], key=str)
    assert contaminated(df, bench.limit(0), block_chars=block_chars).filter("size(matches) > 0").count() == 0
    assert contaminated(docs(spark, []), bench, block_chars=block_chars).collect() == []
