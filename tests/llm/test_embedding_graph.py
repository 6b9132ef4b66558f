import numpy as np
import pytest

from quorum.llm.embedding_graph import near_vectors, robust_pruned, search
from tests.llm.helpers import smallest_reachable

SCHEMA = "vec_id long, embedding array<float>, label int"


def corpus(seed=1, n=600, d=24):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=d)) for i in range(n)]
    for c in range(12):
        base = rng.normal(size=d)
        for _ in range(rng.integers(2, 40)):
            rows.append((len(rows), base * rng.uniform(0.5, 3) + rng.normal(size=d) * rng.choice([0.05, 0.15, 0.3])))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    rows += [(2000 + i, rows[5][1]) for i in range(40)]
    return rows


def brute(rows, threshold=0.9):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            good.setdefault((i, tuple(v)), None)
    keys = list(good)
    links, count = [], {k: set() for k in keys}
    for size in {len(v) for _, v in keys}:
        part = [k for k in keys if len(k[1]) == size]
        x = np.array([v for _, v in part])
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, j in zip(*np.nonzero(x @ x.T >= threshold)):
            if part[i][0] != part[j][0]:
                links.append((part[i][0], part[j][0]))
                count[part[i]].add(part[j])
    label = smallest_reachable([i for i, _ in rows if i is not None], links)
    out = []
    for i, v in rows:
        k = (i, tuple(v)) if v is not None else None
        out.append((i, len(count.get(k, ())), label.get(i), True if i is None else label[i] == i))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"leaf_rows": 80, "shard_rows": 30}])
def test_matches_brute_force(spark, sizes):
    rows = corpus()
    got = sorted((tuple(r) for r in near_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), **sizes).collect()), key=str)
    want = brute(rows)
    if not sizes:
        assert got == want
    else:  # many small shards: a high recall, and no link that is not one
        assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
        assert all(g[1] <= w[1] and g[2] >= w[2] for g, w in zip(got, want))


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (12, [1e-30, 0.0]), (12, [0.0, 5.0]),
            (1, [1.0, 0.0]), (13, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 as key", "2 as rep", "3 as unit")
    got = sorted((tuple(r) for r in near_vectors(df).collect()), key=str)
    # Ids 1, 2 and one vector of 12 are parallel; 10, 11 and the other vector of 12 too.
    component = {1: 1, 2: 1, 12: 1, 10: 1, 11: 1}
    links = {(1, 0): 2, (2, 0): 2, (12, 0): 2, (10, 1): 2, (11, 1): 2, (12, 1): 2}
    want = []
    for i, v in rows:
        axis = None if v is None or len(v) != 2 or v[0] is None else 0 if v[0] in (1.0, 2.0, 1e-30) and v[1] == 0 else 1 if v[1] in (1.0, 5.0) and v[0] == 0 else None
        n = links.get((i, axis), 0)
        want.append((i, n, None if i is None else component.get(i, i), True if i is None else component.get(i, i) == i))
    assert got == sorted(want, key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert near_vectors(empty).collect() == []
    assert [tuple(r) for r in near_vectors(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect()] == [(1, 0, 1, True)]


def test_graph_search_recall():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 32))
    x[:300] = x[0] + rng.normal(size=(300, 32)) * 0.25
    x /= np.linalg.norm(x, axis=1)[:, None]
    lists = robust_pruned(x)
    assert all(i not in v for i, v in enumerate(lists)) and np.mean([len(v) for v in lists]) < 80
    q, j = search(x, lists, x, np.full(len(x), -1), 0.9)      # from the medoid alone
    want = x @ x.T >= 0.9
    assert want[q, j].all()
    assert len(q) >= 0.9 * want.sum()
    q, j = search(x, lists, x, np.arange(len(x)), 0.9)
    assert len(q) >= 0.99 * want.sum()


def test_a_search_short_of_its_recall_is_not_returned(spark, monkeypatch):
    """A search that finds nothing, and links so rare that few of any rows have one."""
    from quorum.llm import embedding_graph as e
    monkeypatch.setattr(e, "search", lambda x, lists, queries, own, threshold: (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)))
    monkeypatch.setattr(e, "OVERLAPS", (2,))
    rows = corpus(seed=4, n=200)
    got = near_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), leaf_rows=100, shard_rows=60).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_audit_asks_rows_with_links_and_ignores_copies(spark):
    from quorum.llm.embedding_graph import audit
    x = np.eye(40)
    x[1], x[3] = x[0], x[2]             # 0-1 found, 2-3 not; 0 and 1 stand for many copies
    classes = spark.createDataFrame([(i, 1000 if i < 2 else 1, v.tolist()) for i, v in enumerate(x)], "rep long, copies long, unit array<double>")
    found = spark.createDataFrame([(0, 1), (1, 1)], "rep long, rows long")
    assert audit(classes, found, 0.9) == 0.5
    none = spark.createDataFrame([(i, 1) for i in range(4)], "rep long, rows long")
    assert audit(classes, none, 0.9) == 1.0
    half = spark.createDataFrame([(i, 2) for i in range(20)], "rep long, rows long")
    same = spark.createDataFrame([(i, 1, [1.0, 0.0]) for i in range(5)], "rep long, copies long, unit array<double>")
    assert audit(same, half.filter("rep < 5"), 0.9, limit=1) == 0.5
