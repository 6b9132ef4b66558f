import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorum.llm import quality_features as q
from quorum.llm.toxicity_grammar import held_out, training_rows
from tests.llm.helpers import docs, prose


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = int(rng.random() < 0.7)
        words = prose(rng, rng.randrange(30, 200), 500)
        if not good:
            kind = rng.randrange(3)
            words = ([w for w in words[:20] for _ in range(9)] if kind == 0 else [w + "%%%" for w in words] if kind == 1
                     else [x for w in words for x in (w, "|")])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, good))
    return rows, labels


def test_learns_and_generalises(spark):
    rows, labels = corpus()
    extra = [(5000, None), (5001, ""), (None, rows[0][1]), (None, None), (5002, "word " * 300_000), (5003, "\0\t\n")]
    table = spark.createDataFrame([*labels, (5000, 1), (None, 1), (3, None), (7, labels[7][1])], "doc_id long, quality int")
    df = docs(spark, rows + extra + rows[:5]).withColumn("label", F.lit(4)).withColumn("x", F.lit(4))
    model = q.fit(df, table, held_out("doc", 3, 1))
    got = {}
    for r in q.score(df, model, carry=("lang",)).collect():
        got.setdefault(r.id, []).append(r.score)
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i][0] >= 0.5) == y for i, y in held]) > 0.95
    assert got[5000] == got[5001] and all(0 <= s <= 1 for v in got.values() for s in v)
    assert len(got[0]) == 2 and got[0][0] == got[0][1] and len(got[None]) == 2
    assert got[5002][0] < 0.5


def test_normal_equations_equal_a_direct_fit(spark):
    rows, labels = corpus(300, 2)
    df, table = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    model = q.fit(df, table, held_out("doc", 3, 1))
    own = [(t, y) for (i, t), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 3 != 1]
    stats = np.array([q.statistics(t.encode()) for t, _ in own])
    assert np.allclose(model.fourier.mean, stats.mean(0)) and np.allclose(model.fourier.deviation[0], stats.std(0)[0])
    x, y = model.fourier(stats), np.array([v for _, v in own], dtype=float)
    want = np.linalg.solve(x.T @ x + q.RIDGE * len(x) * np.eye(x.shape[1]), x.T @ y)
    assert np.allclose(model.weights, want, atol=1e-6)


@pytest.mark.parametrize("bad", [4, 60])
def test_scores_against_a_cross_fit_without_spark(spark, bad):
    """The whole query by hand, with few rows of a label and with many: every row calibrates
    by weights that have not seen its fold."""
    rows, labels = corpus(260, 5)
    zeros = [i for i, y in labels if not y]
    gone = {i for i in zeros if zlib.crc32(str(i).encode()) % 3 != 1}
    gone -= set(sorted(gone)[:bad])
    labels = [(i, y) for i, y in labels if i not in gone]
    df, table = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.id: r.score for r in q.score(df, q.fit(df, table, held_out("doc", 3, 1))).collect()}

    text, label = dict(rows), dict(labels)
    train = [i for i in label if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sum(not label[i] for i in train) <= bad
    stats = np.array([q.statistics(text[i].encode()) for i in train])
    fourier = q.Fourier(stats.mean(0), stats.std(0))
    x, y = fourier(stats), np.array([label[i] for i in train], dtype=float)

    def ridge(x, y):
        return np.linalg.solve(x.T @ x + q.RIDGE * max(1, len(x)) * np.eye(x.shape[1]), x.T @ y)

    fold = np.array([zlib.crc32(f"calibration {i}".encode()) % 5 for i in train])
    out = np.array([x[k] @ ridge(x[fold != fold[k]], y[fold != fold[k]]) for k in range(len(train))])
    cell = np.clip(np.round((out + 0.5) / 2 * q.GRID), 0, q.GRID).astype(int)
    knots, levels = q.isotonic(np.arange(q.GRID + 1) / q.GRID * 2 - 0.5, np.bincount(cell, y, q.GRID + 1),
                               np.bincount(cell, 1 - y, q.GRID + 1))
    weights = ridge(x, y)
    for i, t in rows:
        want = np.interp(fourier(q.statistics(t.encode())[None])[0] @ weights, knots, levels)
        assert abs(got[i] - want) < 1e-6


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    a = rng.normal(0, 0.5, (40, q.N_STATS))
    f = q.Fourier(np.zeros(q.N_STATS), np.ones(q.N_STATS))(a)[:, :-1]
    want = np.exp(-((a[:, None] - a[None]) ** 2).sum(-1) / (2 * q.WIDTH ** 2))
    assert np.abs(f @ f.T - want).mean() < 0.08


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(20):
        ones, zeros = rng.integers(0, 6, 15).astype(float), rng.integers(0, 6, 15).astype(float)
        knots, levels = q.isotonic(np.arange(15.0), ones, zeros)
        assert (np.diff(knots) > 0).all() and (np.diff(levels) >= 0).all()
        total = ones + zeros
        # The block means are the largest slopes of the cumulative sums' lower hull.
        mean = [max(min(ones[i:j + 1].sum() / total[i:j + 1].sum() for j in range(k, 15) if total[i:j + 1].sum())
                    for i in range(k + 1) if any(total[i:j + 1].sum() for j in range(k, 15))) for k in range(15) if total[k]]
        assert len(knots) == len(set(np.round(mean, 12)))


def test_without_labels_and_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.fit(docs(spark, [(1, "a")]), none, held_out("doc", 3, 1))
    assert [r.score for r in q.score(docs(spark, [(1, "a b")]), model).collect()] == [0.5]
    assert q.score(docs(spark, []), model).collect() == []
    table = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert training_rows(docs(spark, [(i, "x") for i in range(50)]), table, "quality", F.lit(False), 10).count() == 10
