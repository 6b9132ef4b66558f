import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorum.llm import ns_clusters as ns
from quorum.llm.integer_vectors import squared_distances

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, own string, near string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def brute(rows, k, size, rounds):
    """Lloyd's rounds with every distance, in Python integers: {row number: (cluster, distance)}, centroids."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centers = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for c in range(len(centers)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                centers[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centers


def rows_of(rng, n, size, spread):
    middle = rng.normal(size=(5, size))
    x = middle[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, size))
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def check(spark, rows, k, size, rounds):
    got = ns.cluster(table(spark, rows), k=k, size=size, rounds=rounds).collect()
    want, centers = brute(rows, k, size, rounds)
    assert sorted(((r.id is None, r.id, r.cluster, r.distance) for r in got), key=str) == \
        sorted(((i is None, i, c, d) for i, c, d in want), key=str)
    per = {}
    for _, c, d in want:
        per[c] = per.get(c, 0) + d
    for r in got:
        assert r.cluster_inertia == per[r.cluster] and r.inertia == sum(per.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centers[r.cluster])).encode()).hexdigest()
    return got


@pytest.mark.parametrize("rounds", [0, 1, 7])
def test_equals_full_rescans(spark, rounds):
    check(spark, rows_of(np.random.default_rng(rounds), 400, 6, 0.5), 7, 6, rounds)


def test_early_end_when_nothing_moves(spark):
    check(spark, rows_of(np.random.default_rng(9), 60, 4, 0.01), 3, 4, 12)


def test_ties_repeats_and_hot_cluster(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(c) for c in rng.integers(-2, 3, 3) / 512]) for i in range(150)]
    rows += [(500 + i, [0.0, 0.0, 0.0]) for i in range(100)] + rows[:20]   # a third are one vector; ids repeat
    check(spark, rows, 6, 3, 6)


def test_rows_that_are_not_kept(spark):
    rows = [(1, [0.1, 0.2]), (2, None), (3, [None, 0.1]), (4, [float("nan"), 0.0]), (5, [float("inf"), 1.0]), (6, []),
            (7, [0.1, 0.2, 0.3]), (None, [-0.5, -0.5]), (8, [-0.1, 0.0])]
    got = check(spark, rows, 8, 2, 4)
    assert sorted(str(r.id) for r in got) == ["1", "8", "None"]


def test_empty_table_and_no_kept_vector(spark):
    for rows in ([], [(1, None), (2, [0.0])]):
        got = ns.cluster(table(spark, rows), size=2)
        assert got.count() == 0 and got.columns[:3] == ["id", "cluster", "distance"]


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="too large"):
        ns.cluster(table(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])]), size=2).collect()


def test_bounds_skip_most_distances_and_never_change_a_row():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(8, 64))[rng.integers(0, 8, 4000)] * 200 + 20 * rng.normal(size=(4000, 64))).astype(np.int64)
    history = x[:8][None]
    own, near, taken = ns.first_assignment(x, history[0])
    taken_in_all = 0
    for _ in range(8):
        means = np.array([x[own == c].sum(0) // (own == c).sum() if (own == c).any() else history[-1][c] for c in range(8)])
        history = np.concatenate([history, means[None]])
        own, evaluations = ns.reassign(x, own, near, taken, history)
        assert (own == squared_distances(x, means).argmin(axis=1)).all()
        taken_in_all += int(evaluations.sum())
    assert taken_in_all < 0.5 * 8 * x.shape[0] * 8


def test_total_displacement_is_below_summed_drifts():
    """A centroid that comes back costs nothing: its displacement since the evaluation is zero."""
    x = np.array([[0], [100]])
    there, back = np.array([[0], [100]]), np.array([[45], [100]])
    own, near, taken = ns.first_assignment(x, there)
    history = np.stack([there, back, there])
    own, evaluations = ns.reassign(x, own, near, taken, history)
    assert evaluations.sum() == 0 and own.tolist() == [0, 1]


def test_exact_beyond_doubles(spark):
    rows = [(i, [float((i * 7919) % 1000) * 90.0, float(i) * 0.5, -float(i % 13) * 77.0]) for i in range(80)]
    check(spark, rows, 5, 3, 5)
    a = np.array([[2 ** 27, -2 ** 27]]), np.array([[-2 ** 27, 2 ** 27 - 1]])
    assert squared_distances(*a)[0, 0] == (2 ** 28) ** 2 + (2 ** 28 - 1) ** 2


def test_rounds_leave_one_state_table(spark, tmp_path):
    import os
    from quorum.session import checkpoint_root
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    ns.cluster(table(spark, rows_of(np.random.default_rng(1), 200, 4, 0.8)), k=5, size=4, rounds=4).select(F.max("inertia")).collect()
    assert len([d for d in set(os.listdir(root)) - before if d.startswith("ns-state")]) <= 2
