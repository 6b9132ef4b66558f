import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quorum.llm import minhash_forest
from quorum.llm.common import components
from quorum.llm.minhash_forest import near_duplicates
from quorum.llm.shingles import shingle_set, word_hashes
from tests.llm.helpers import docs, prose, smallest_reachable


def brute_sets(rows, k):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        width = min(k, len(words))
        out.append({tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set())
    return out


def brute(rows, k, percent=80):
    sets = brute_sets(rows, k)
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    ids = [i for i, _ in rows]
    label = smallest_reachable(ids, links)
    return sorted((i, len(s), label[i], label[i] == i) for i, s in zip(ids, sets))


def edited(rng, words, share):
    return [rng.choice(["x1", "y2", "z3"]) + str(rng.random()) if rng.random() < share else w for w in words]


def corpus(seed=1, family=90):
    rng = random.Random(seed)
    rows = [(i, " ".join(prose(rng, rng.randrange(1, 120)))) for i in range(60)]
    for base in range(12):
        words = prose(rng, 150)
        for _ in range(rng.randrange(2, 7)):
            rows.append((len(rows), "  ".join(edited(rng, words, 0.02))))
    words = prose(rng, 200)
    for _ in range(family):
        rows.append((len(rows), "\n".join(edited(rng, words, 0.012))))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \t\n", "One", "one", "ONE two", "one two",
                                                       "é ü ÀB", "é ü Àb", "one two three"])]
    rows += [(len(rows) + i, rows[i % 7][1]) for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,regions", [(4, {}), (5, {}), (4, {"pair_region": 4, "task_region": 40})])
def test_matches_brute_force(spark, k, regions):
    rows = corpus()
    got = near_duplicates(docs(spark, rows), k=k, **regions).collect()
    expected = brute(rows, k)
    if regions:  # deeper regions may miss links, but never invent one
        want = {r[0]: r[2] for r in expected}
        assert all(r.component_id >= want[r.id] for r in got)
    else:
        assert sorted(tuple(r) for r in got) == expected


def test_equal_signatures_beyond_a_task(spark):
    """Equal sets of minima in a region larger than a task: the star and its remainder."""
    rng = random.Random(3)
    words = prose(rng, 4000, 100000)
    rows = [(i, " ".join(words[:i] + [f"new{i}"] + words[i + 1:])) for i in range(1, 60)]
    got = near_duplicates(docs(spark, rows), k=4, pair_region=2, task_region=3).collect()
    assert {r.component_id for r in got} == {1}


def test_defined_cases(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (None, "alone here in this text"), (None, None),
            (9, "q r s t u v w"), (9, "a b c d e f"), (7, "q r s t u v w"), (8, "long " * 300_000)]
    got = sorted(((r.id, r.n_shingles, r.component_id, r.kept) for r in
                  near_duplicates(docs(spark, rows), k=4).collect()), key=str)
    assert got == sorted([(None, 3, 4, False), (4, 3, 4, True), (None, 2, None, True), (None, 0, None, True),
                          (9, 4, 4, False), (9, 3, 4, False), (7, 4, 4, False), (8, 1, 8, True)], key=str)
    assert near_duplicates(docs(spark, [])).collect() == []


def test_extra_columns_and_long_texts(spark):
    df = docs(spark, [(1, "a b c d e"), (2, "a b c d e")]).selectExpr("*", "1 as rep", "2 as fp", "3 as n", "4 as id")
    assert {r.component_id for r in near_duplicates(df).collect()} == {1}
    text = (" ".join(prose(random.Random(2), 400_000, 50_000))).encode()
    assert len(text) > 2 << 20
    whole = word_hashes(text)
    assert len(whole) == 400_000
    one = word_hashes(text.split()[123456])
    assert whole[123456] == one[0]
    assert len(shingle_set(text, 4)) > 390_000


def test_components_of_chains_hubs_and_loops(spark):
    rng = np.random.default_rng(5)
    pairs = [(i, i + 1) for i in range(100, 400)] + [(7, i) for i in range(1000, 1200)] + [(5, 5)] + \
        [tuple(int(x) for x in rng.integers(2000, 2200, 2)) for _ in range(150)]
    rng.shuffle(pairs)
    pairs = [(int(a), int(b)) for a, b in pairs]
    nodes = sorted({x for a, b in pairs if a != b for x in (a, b)})
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = smallest_reachable(nodes, [p for p in pairs if p[0] != p[1]])
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize("regions", [{"pair_region": 4, "task_region": 8}, {"pair_region": 2, "task_region": 40},
                                     {"pair_region": 2, "task_shingles": 2000}])
def test_regions_beyond_a_task_are_exact(spark, regions):
    """Families spread around the threshold, so that prefixes deeper than a region's part."""
    rng = random.Random(8)
    rows = corpus(seed=8, family=60)
    for share in (0.02, 0.03, 0.04):
        words = prose(rng, 120, 5000)
        rows += [(len(rows) + i, " ".join(edited(rng, words, share))) for i in range(50)]
    got = near_duplicates(docs(spark, rows), k=4, **regions).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4)


def test_depth_adapts_to_a_templated_source(spark, monkeypatch):
    """A source of pages from one template: regions beyond a task are sorted by deeper prefixes,
    over fewer sets, and the links are those of brute force."""
    seen = []
    regions = minhash_forest._regions

    def counted(rows, depth, orders):
        seen.append((depth, rows.count()))
        return regions(rows, depth, orders)

    monkeypatch.setattr(minhash_forest, "_regions", counted)
    rng = random.Random(11)
    template = prose(rng, 160, 5000)
    rows = [(i, " ".join(prose(rng, 40))) for i in range(60)]
    for _ in range(140):        # about the threshold on both sides
        rows.append((len(rows), " ".join(edited(rng, template, rng.choice((0.005, 0.03, 0.05))))))
    got = near_duplicates(docs(spark, rows), k=4, pair_region=3, task_region=12).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4)
    assert [depth for depth, _ in seen][:2] == [3, 5] and seen[1][1] < seen[0][1]


def test_neighbours_across_batches():
    """Rows with a neighbour of the whole depth stay, wherever the batches end; so do the ends."""
    prefixes = [(1, 1), (1, 2), (1, 2), (3, 4), (5, 6), (5, 6), (5, 6), (7, 7), (8, 8), (9, 9)]
    want = {0, 1, 2, 4, 5, 6, 9}
    raw = [np.array(p, dtype=">u4").tobytes() for p in prefixes]
    for size in (1, 2, 3, 4, 10):
        batches = [pa.RecordBatch.from_arrays(
            [pa.array([0] * len(raw[i:i + size]), pa.int32()), pa.array(raw[i:i + size], pa.binary()),
             pa.array(range(i, i + len(raw[i:i + size])), pa.int64()), pa.array([1] * len(raw[i:i + size]), pa.int64())],
            names=["tree", "prefix", "rep", "n"]) for i in range(0, len(raw), size)]
        out = list(minhash_forest._neighbours(2)(iter(batches)))
        keys = {r: k for b in out for r, k in zip(b.column(1).to_pylist(), b.column(0).to_pylist())}
        assert sum(b.num_rows for b in out) == len(want) and set(keys) == want
        assert keys[1] == keys[2] != keys[0] and keys[4] == keys[5] == keys[6]


def test_levels_hold_their_miss():
    for depth, orders in minhash_forest.LEVELS:
        assert (1 - 0.8 ** depth) ** orders <= 1.1e-5
        taken = minhash_forest.sequences(depth, orders)
        assert taken.shape == (orders, depth) and all(len(set(row)) == depth for row in taken.tolist())
