import hashlib
import math

import numpy as np
import pytest

from quorum.llm.gnat_codes import Gnat, compress

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, code string, of int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "x", "x", 1) for i, v, label in rows], SCHEMA)


def brute(rows, size, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    same = [r for r in kept if len(r[1]) == size]
    w = size // parts
    first = sorted(same, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * w:(p + 1) * w] for _, v, _ in first] for p in range(parts)]

    def near(v, p):
        part = v[p * w:(p + 1) * w]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(books[p]))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            own = [near(v, p)[1] for _, v, _ in same]
            for e in set(own):
                mine = [v[p * w:(p + 1) * w] for (_, v, _), o in zip(same, own) if o == e]
                new[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
        books = new
    name = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, errors = [], {}
    for i, v, label in kept:
        if len(v) != size:
            found.append((i, None, None, label))
            continue
        at = [near(v, p) for p in range(parts)]
        error = sum(d for d, _ in at)
        errors[label] = errors.get(label, 0) + error
        found.append((i, "".join(f"{e:02x}" for _, e in at), error, label))
    return [(i, code, error, errors.get(label), name) for i, code, error, label in found]


def check(spark, rows, size, **kw):
    got = [tuple(r) for r in compress(table(spark, rows), **kw).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, size, **kw), key=str)
    return got


def vectors(rng, n, size):
    return [(int(i), [float(np.float32(c)) for c in rng.normal(size=size)], int(i) % 3) for i in range(n)]


def test_equals_every_distance_taken(spark):
    check(spark, vectors(np.random.default_rng(0), 300, 12), 12)


def test_few_entries_and_rounds(spark):
    check(spark, vectors(np.random.default_rng(1), 90, 8), 8, entries=20, rounds=2)
    check(spark, vectors(np.random.default_rng(2), 15, 8), 8, parts=2, rounds=0)


def test_ties_repeats_hot_and_null_labels(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(c) / 512 for c in rng.integers(-1, 2, 8)], None if i % 2 else 5) for i in range(120)]
    rows += [(1000 + i, [0.0] * 8, None) for i in range(80)] + rows[:10] + [(None, [0.25] * 8, 7)]
    check(spark, rows, 8, entries=40)


def test_dropped_and_odd_rows(spark):
    rows = [(1, [0.1] * 4, 1), (2, None, 1), (3, [None] * 4, 1), (4, [float("nan")] * 4, 2), (5, [float("-inf")] * 4, 2),
            (6, [0.5] * 8, 2), (7, [], 2), (8, [0.3] * 4, 1), (0, [0.1] * 3, 1)]
    got = check(spark, rows, 4)
    assert sorted(r[0] for r in got) == [0, 1, 6, 7, 8] and [r[1] for r in got if r[0] in (0, 6, 7)] == [None] * 3


def test_empty_table_and_no_fitting_vector(spark):
    assert compress(table(spark, [])).count() == 0
    got = compress(table(spark, [(1, [0.1], 1), (2, [], 1), (3, None, 1)])).collect()
    assert sorted(tuple(r) for r in got) == [(1, None, None, None, None), (2, None, None, None, None)]


@pytest.mark.parametrize("spread", [1, 3, 400, 2 ** 26])
@pytest.mark.parametrize("degree,leaf", [(2, 1), (3, 4), (12, 10)])
def test_tree_finds_the_lowest_nearest_entry(spread, degree, leaf):
    rng = np.random.default_rng(spread)
    for n in (1, 2, 17, 256):
        entries, queries = rng.integers(-spread, spread + 1, (n, 3)), rng.integers(-spread, spread + 1, (500, 3))
        tree = Gnat(entries, degree, leaf)
        index, squared = tree.nearest(queries)
        every = ((queries[:, None] - entries[None]) ** 2).sum(2)
        assert (index == every.argmin(1)).all() and (squared == every.min(1)).all()
        if n == 256 and degree == 12 and spread > 3:
            assert tree.evaluations < 0.5 * every.size


def test_equal_entries_use_the_first(spark):
    tree = Gnat(np.zeros((256, 4), dtype=np.int64))
    assert tree.nearest(np.ones((5, 4), dtype=np.int64))[0].tolist() == [0] * 5
