"""Near-duplicate embeddings by robust-pruned flat graphs on overlapping cluster shards.

1. equal vectors collapse to one row with a count of their ids;
2. centroids of two levels are fitted on at most ``SAMPLE`` rows (by hash order); every row
   is dealt to its ``overlap`` nearest leaves, and a leaf beyond ``SHARD_ROWS`` rows to parts
   of that size, so a task holds a bounded number of rows whatever a leaf's size;
3. each shard builds a flat graph: of a row's nearest rows those stay that no kept one
   covers (robust pruning), and edges go both ways; a row's lists of all its shards unite;
4. every row searches its leaves: a greedy search from the shard's medoid and from the row
   itself, which goes on to the neighbours of everything within range.  Cosines are taken in
   double precision, so a link found is a link; parts of one leaf are compared with each other
   row by row; a pair that meets in several leaves counts
   in the first of them, and of a shard's links only a spanning forest leaves the task;
5. an audit compares at most ``AUDIT`` rows with links and as many of all rows with all rows
   by brute force.  Below the wanted recall the search is repeated with a larger overlap, and
   where none is enough every block of rows is compared with every other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from quorum.llm.common import components, cut

SAMPLE = 32_768
LEVEL = 64              # most centroids per level
LEAF_ROWS = 2_000       # wanted rows of a leaf
SHARD_ROWS = 4_096
DEGREE = 32
CANDIDATES = 96
ALPHA = 1.2
BEAM = 48
AUDIT = 1_024
RECALL = 0.98
OVERLAPS = (2, 4, 8)
_BLOCK = 512
_FOUND = "u long, v long, links long, rows long"


def _valid(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision, and a digest of the vector as given."""
    for batch in rows:
        keys, units, sizes = [], [], []
        for v in batch.column(1).to_pylist():
            ok = v is not None and len(v) > 0 and None not in v
            x = np.array(v, dtype=np.float64) if ok else np.empty(0)
            ok = ok and bool(np.isfinite(x).all()) and bool(np.any(x))
            if ok:
                x = x + 0.0                     # -0.0 equals 0.0
                scaled = x / np.abs(x).max()    # no overflow or underflow of the squares
                units.append(scaled / np.sqrt(scaled @ scaled))
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                sizes.append(len(x))
            else:
                units.append(None)
                keys.append(None)
                sizes.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(units, pa.list_(pa.float64())), pa.array(sizes, pa.int32())],
            names=["id", "key", "unit", "size"])


def _lloyd(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ centers.T, axis=1)
        for c in range(k):
            own = x[near == c]
            if len(own):
                mean = own.mean(axis=0)
                norm = np.sqrt(mean @ mean)
                centers[c] = mean / norm if norm > 1e-12 else own[0]
    return centers


def fit_centroids(sample: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """(leaf centroids, their top centroid's number) of two levels, from a bounded sample."""
    top = min(LEVEL, max(1, int(np.sqrt(leaves))))
    centers = _lloyd(sample, top, 1)
    near = np.argmax(sample @ centers.T, axis=1)
    found, owner = [], []
    for c in range(len(centers)):
        own = sample[near == c]
        if len(own):
            part = _lloyd(own, min(LEVEL, max(1, round(leaves * len(own) / len(sample)))), c + 2)
            found.append(part)
            owner += [c] * len(part)
    return np.concatenate(found), np.array(owner)


def _dealt(centers: np.ndarray, overlap: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            x = np.array(batch.column(2).to_pylist(), dtype=np.float64).reshape(batch.num_rows, centers.shape[1])
            k = min(overlap, len(centers))
            near = np.sort(np.argsort(-(x @ centers.T), axis=1, kind="stable")[:, :k], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))],
                                             names=["rep", "copies", "unit", "leaves"])
    return run


def _units(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.values.to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, 0))


def robust_pruned(x: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of the rows of a shard: pruned nearest rows, edges both ways."""
    n = len(x)
    s = (x @ x.T).astype(np.float32)
    np.fill_diagonal(s, -np.inf)
    width = min(CANDIDATES, n - 1)
    if width <= 0:
        return [np.empty(0, dtype=np.int64)] * n
    near = np.argpartition(-s, width - 1, axis=1)[:, :width]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, axis=1), axis=1, kind="stable"), axis=1)
    rows = np.arange(n)
    kept = np.zeros((n, DEGREE), dtype=np.int64)
    count = np.zeros(n, dtype=np.int64)
    for c in range(width):
        q = near[:, c]
        far = np.maximum(2 - 2 * s[rows, q], 0)
        # A kept row covers the candidate if it is nearer to it by the factor ALPHA.
        between = np.maximum(2 - 2 * s[q[:, None], kept], 0)
        between[~(np.arange(DEGREE)[None, :] < count[:, None])] = np.inf
        add = ~((ALPHA * between <= far[:, None]).any(axis=1)) & (count < DEGREE)
        kept[add, count[add]] = q[add]
        count += add
    source = np.repeat(rows, count)
    target = np.concatenate([kept[i, :count[i]] for i in range(n)])
    both = np.unique(np.concatenate([source * n + target, target * n + source]))
    return np.split(both % n, np.searchsorted(both // n, np.arange(1, n)))


def _built(rows: pa.Table) -> pa.Table:
    ids, x = rows["rep"].to_numpy(), _units(rows["unit"])
    lists = robust_pruned(x)
    return pa.table({"rep": pa.array(ids), "near": pa.array([ids[v] for v in lists], pa.list_(pa.int64()))})


def search(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, own: np.ndarray, threshold: float):
    """Pairs (query, row) within range that the graph search finds.

    ``own``: the query's position among the rows, or -1.  Each round expands every row
    within range not yet expanded and the best few others, up to ``BEAM`` of these.
    """
    n = len(x)
    degree = np.array([len(v) for v in lists])
    first = np.cumsum(degree) - degree
    flat = np.concatenate([*lists, np.empty(0, dtype=np.int64)])
    mean = x.mean(axis=0)
    medoid = int(np.argmax(x @ mean))
    found_q, found_x = [], []
    for at in range(0, len(queries), _BLOCK):
        q = queries[at:at + _BLOCK]
        b = len(q)
        sims = np.full((b, n), -np.inf)
        expanded = np.zeros((b, n), dtype=bool)
        cells = np.arange(b) * n + medoid
        mine = own[at:at + _BLOCK]
        cells = np.unique(np.concatenate([cells, (np.arange(b) * n + mine)[mine >= 0]]))
        spent = np.zeros(b, dtype=np.int64)
        while len(cells):
            i, j = np.divmod(cells, n)
            sims.ravel()[cells] = np.einsum("ij,ij->i", q[i], x[j])
            # Expand the range, and the four best others while the beam lasts.
            new = (sims >= threshold) & ~expanded
            greedy = np.flatnonzero(spent < BEAM)
            if len(greedy):
                open_ = np.where(expanded[greedy] | new[greedy], -np.inf, sims[greedy])
                k = min(4, n)
                best = np.argpartition(-open_, k - 1, axis=1)[:, :k]
                good = np.isfinite(np.take_along_axis(open_, best, axis=1))
                new[np.repeat(greedy, good.sum(axis=1)), best[good]] = True
                spent[greedy] += np.maximum(1, good.sum(axis=1))
            i, j = np.nonzero(new)
            expanded |= new
            if not len(i):
                break
            size = degree[j]
            offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            cells = np.repeat(i, size) * n + flat[np.repeat(first[j], size) + offset]
            cells = np.unique(cells[np.isneginf(sims.ravel()[cells])])
            if not len(cells) and (spent < BEAM).any() and np.isfinite(np.where(expanded, -np.inf, sims)).any():
                # Nothing new to measure, but the beam has rows left to expand.
                cells = np.flatnonzero(np.isfinite(sims.ravel()) & ~expanded.ravel())[:1]
        i, j = np.nonzero(sims >= threshold)
        found_q.append(i + at)
        found_x.append(j)
    return np.concatenate([*found_q, np.empty(0, dtype=np.int64)]), np.concatenate([*found_x, np.empty(0, dtype=np.int64)])


def compared(x: np.ndarray, queries: np.ndarray, threshold: float):
    """All pairs (query, row) within range."""
    found_q, found_x = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for at in range(0, len(queries), _BLOCK):
        i, j = np.nonzero(queries[at:at + _BLOCK] @ x.T >= threshold)
        found_q.append(i + at)
        found_x.append(j)
    return np.concatenate(found_q), np.concatenate(found_x)


def _searched(threshold: float, exact: bool = False):
    def run(table: pa.Table) -> pa.Table:
        role = table["role"].to_numpy()
        ids, copies, leaf = table["rep"].to_numpy(), table["copies"].to_numpy(), table["leaf"][0].as_py()
        x = _units(table["unit"])
        member, asking = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        none = pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "links": pa.array([], pa.int64()),
                         "rows": pa.array([], pa.int64())})
        if not len(member) or not len(asking):
            return none
        if exact or not (role == 3).any():
            i, j = compared(x[member], x[asking], threshold)
        else:
            place = {int(i): k for k, i in enumerate(ids[member])}
            near = table["near"].combine_chunks()
            lists = [np.array([place[i] for i in (v or ()) if i in place], dtype=np.int64)
                     for v in near.take(pa.array(member)).to_pylist()]
            own = np.array([place.get(int(i), -1) for i in ids[asking]])
            i, j = search(x[member], lists, x[asking], own, threshold)
        a, b = asking[i], member[j]
        other = ids[a] != ids[b]
        a, b = a[other], b[other]
        # A pair counts in the first leaf that both are dealt to.
        width = max((len(v) for v in table["leaves"].to_pylist()), default=1)
        dealt = np.array([v + [-1] * (width - len(v)) for v in table["leaves"].to_pylist()])
        first = np.full(len(a), np.iinfo(np.int64).max)
        for k in range(width):
            own_leaf = dealt[a, k]
            both = (own_leaf >= 0) & (dealt[b] == own_leaf[:, None]).any(axis=1)
            first = np.where(both, np.minimum(first, own_leaf), first)
        counted = first == leaf
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, a[counted], copies[b[counted]])
        met = np.bincount(a[counted], minlength=len(ids))
        # A spanning forest of the shard's links.
        label = np.arange(len(ids))

        def root(k: int) -> int:
            while label[k] != k:
                label[k] = label[label[k]]
                k = label[k]
            return k

        node = {}
        for k, r in enumerate(ids.tolist()):
            node.setdefault(r, k)
        u, v = [], []
        slot = np.array([node[r] for r in ids.tolist()])
        for k, m in zip(slot[a].tolist(), slot[b].tolist(), strict=True):
            r, s = root(k), root(m)
            if r != s:
                label[max(r, s)] = min(r, s)
                u.append(int(ids[k]))
                v.append(int(ids[m]))
        some = np.flatnonzero(links)
        return pa.table({"u": pa.array([*u, *ids[some].tolist()], pa.int64()),
                         "v": pa.array([*v, *([None] * len(some))], pa.int64()),
                         "links": pa.array([*([None] * len(u)), *links[some].tolist()], pa.int64()),
                         "rows": pa.array([*([None] * len(u)), *met[some].tolist()], pa.int64())})
    return run


def _shards(classes: DataFrame, centers: np.ndarray, overlap: int, shard_rows: int) -> DataFrame:
    """(rep, copies, unit, leaves, leaf, parts, part) of each row and leaf."""
    dealt = cut(classes.select("rep", "copies", "unit").mapInArrow(
        _dealt(centers, overlap), "rep long, copies long, unit array<double>, leaves array<int>"), "dealt")
    each = dealt.select("*", F.explode("leaves").alias("leaf"))
    sizes = each.groupBy("leaf").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"))
    return each.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts").cast("long")).cast("int"))


def _links(classes: DataFrame, centers: np.ndarray, overlap: int, threshold: float, shard_rows: int) -> DataFrame:
    shards = _shards(classes, centers, overlap, shard_rows)
    graph = shards.select("leaf", "part", "rep", "unit").groupBy("leaf", "part") \
        .applyInArrow(_built, "rep long, near array<long>")
    united = cut(graph.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    rows = shards.join(united, "rep", "left")
    return _blocks(rows).applyInArrow(_searched(threshold), _FOUND)


def _blocks(rows: DataFrame) -> GroupedData:
    """A leaf of several parts is searched block against block: (part indexed, part asking)."""
    numbers = F.sequence(F.lit(0), F.col("parts") - 1)
    same = rows.select("*", F.col("part").alias("index"), F.col("part").alias("ask"), F.lit(3).alias("role"))
    index = rows.filter("parts > 1").select("*", F.col("part").alias("index"), F.explode(numbers).alias("ask"), F.lit(1).alias("role"))
    ask = rows.filter("parts > 1").select("*", F.explode(numbers).alias("index"), F.col("part").alias("ask"), F.lit(2).alias("role"))
    return same.union(index.filter("index <> ask")).union(ask.filter("index <> ask")).groupBy("leaf", "index", "ask")


def _all_links(classes: DataFrame, threshold: float, shard_rows: int) -> DataFrame:
    """The links of ``_links`` by comparing all rows, as one leaf."""
    parts = max(1, -(-classes.count() // shard_rows))
    rows = classes.select("rep", "copies", "unit", F.array(F.lit(0)).alias("leaves"), F.lit(0).alias("leaf"), F.lit(parts).alias("parts"),
                          F.pmod(F.xxhash64("rep"), F.lit(parts).cast("long")).cast("int").alias("part"),
                          F.lit(None).cast("array<long>").alias("near"))
    return _blocks(rows).applyInArrow(_searched(threshold, exact=True), _FOUND)


def audit(classes: DataFrame, found: DataFrame, threshold: float, limit: int = AUDIT) -> float:
    """Recall of a bounded set of rows against brute force, the mean over rows with links.

    ``found``: (rep, rows), how many rows each links to.  The lesser of two recalls: of rows
    that were found to have links, which are there where links are rare, and of any rows.
    Copies do not weigh.
    """
    some = classes.orderBy(F.xxhash64("rep"), "rep").limit(limit).select("rep", F.lit(0).alias("kind"))
    linked = found.select("rep").orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(limit).select("rep", F.lit(1).alias("kind"))
    asked = some.union(linked).groupBy("rep").agg(F.collect_set("kind").alias("kinds")) \
        .join(classes.select("rep", "unit"), "rep").join(found, "rep", "left").select("rep", "kinds", "unit", "rows").collect()
    if not asked:
        return 1.0
    ids, q = np.array([r["rep"] for r in asked]), np.array([r["unit"] for r in asked])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            i, j = compared(_units(batch.column(1)), q, threshold)
            n = np.bincount(i[ids[i] != batch.column(0).to_numpy()[j]], minlength=len(ids))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some])], names=["rep", "n"])

    true = {r["rep"]: r["n"] for r in classes.select("rep", "unit").mapInArrow(run, "rep long, n long")
            .groupBy("rep").agg(F.sum("n").alias("n")).collect()}
    shares = [[(r["rows"] or 0) / true[r["rep"]] for r in asked if kind in r["kinds"] and r["rep"] in true] for kind in (0, 1)]
    return min((float(np.mean(x)) for x in shares if x), default=1.0)


def _counts(found: DataFrame) -> DataFrame:
    return found.filter("links is not null").groupBy(F.col("u").alias("rep")) \
        .agg(F.sum("links").alias("links"), F.sum("rows").alias("rows"))


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                 leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS, recall: float = RECALL) -> DataFrame:
    """One row per row of ``table``: ``(id, n_links, component_id, kept)``.

    ``n_links`` counts the other ids whose vectors have a cosine of at least ``threshold``;
    ``component_id`` is the smallest id reachable by links.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; vectors of different lengths do not link; rows that repeat an id and
    vector count once; an id with several vectors is one node of the components, and each of
    its rows counts its own vector's links; a row with a null id links with nothing, its
    component is null and it is kept; an empty table gives an empty result; other columns
    are not read.
    """
    rows = cut(table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
               .mapInArrow(_valid, "id long, key binary, unit array<double>, size int"), "vectors")
    named = rows.filter("id is not null and key is not null")
    # Equal vectors: their ids counted once each, in two steps so that a hot vector spreads.
    classes = cut(named.groupBy("key", "id").agg(F.first("unit").alias("unit"), F.first("size").alias("size"))
                  .groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"),
                                      F.first("unit").alias("unit"), F.first("size").alias("size")), "classes")
    # A class is a node of its own in the graph even where one id has several vectors.
    classes = cut(classes.withColumn("node", F.xxhash64("key")), "nodes")
    counts = links = None
    for size in [r["size"] for r in classes.select("size").distinct().collect()]:
        own = classes.filter(F.col("size") == size).select(F.col("node").alias("rep"), "copies", "unit")
        n = own.count()
        sample = np.array([r["unit"] for r in own.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("unit").collect()])
        for overlap in OVERLAPS:
            centers, _ = fit_centroids(sample, max(1, -(-n * overlap // leaf_rows)))
            found = cut(_links(own, centers, overlap, threshold, shard_rows), "links")
            each = _counts(found)
            if audit(own, each.select("rep", "rows"), threshold) >= recall:
                break
            if overlap == OVERLAPS[-1] or len(centers) <= overlap:
                found = cut(_all_links(own, threshold, shard_rows), "links")
                each = _counts(found)
                break
        each = each.select("rep", "links")
        edges = found.filter("v is not null").select("u", "v")
        counts, links = (each, edges) if counts is None else (counts.union(each), links.union(edges))
    if counts is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    names = classes.select("node", "rep")
    named_links = links.join(names.select(F.col("node").alias("u"), F.col("rep").alias("a")), "u") \
        .join(names.select(F.col("node").alias("v"), F.col("rep").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    repeated = named.groupBy("id").agg(F.count_distinct("key").alias("n")).filter("n > 1")
    several = named.join(repeated, "id", "left_semi").join(classes.select("key", "rep"), "key") \
        .select(F.least("id", "rep").alias("u"), F.greatest("id", "rep").alias("v"))
    label = components(named_links.union(several))
    per_class = classes.join(counts.select(F.col("rep").alias("node"), "links"), "node", "left") \
        .join(label.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component"))
    out = rows.join(per_class, "key", "left")
    named_row = F.col("id").isNotNull()
    out = out.select("id", F.when(named_row, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
                     F.when(named_row, F.coalesce("component", "id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
