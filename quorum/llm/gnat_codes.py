"""Vector code compression: product codes whose nearest entries a GNAT finds.

A vector of integers is cut into equal consecutive parts; each part is replaced by the index of
the nearest of up to 256 codebook entries.  The entries of a part position are put into a GNAT
(geometric near-neighbour access tree): a node holds split points, every other entry belongs to
the child of its nearest split point, and the node stores for each split point and each child
the least and greatest distance between the point and the child's entries.  A query takes its
exact distances to the split points; by the triangle inequality a child is out as soon as one of
them lies further from its stored range than the best distance so far.  The elimination is
strict (equal bounds are followed, since an equal distance at a lower index wins) and rounds
against eliminating; what remains is decided by exact integers, ties to the lower index.

Trees answer a batch of queries at a time: first the child of each query's nearest split point,
which gives a near best, then the children that are still possible.

On Spark: a round is one pass over the vectors (no state between rounds, nothing is written);
a task holds the four trees (parameters) and adds its parts up per entry before it emits them,
so a hot entry costs one row per task; parts x entries rows of sums reach the driver.  The final
codes are written once; errors are summed per label with map-side partial aggregation and joined
back, a join that AQE splits at a hot label.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped.
All others are in the result; the length of vectors is that of the one with the smallest id among
those with a length that parts divide, and vectors of another length, which no codebook fits,
have null code and error and add nothing to sums.  Repeated rows and ids are vectors of their
own; null ids are the largest; fewer than 256 vectors give as many entries; equal entries leave
the later one unused; an empty table gives an empty result; null labels are one group;
further columns are ignored.  The table holds no texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import batches, cut
from quorum.llm.integer_vectors import digest, floor_mean, integer_vectors, matrix, squared_distances

PARTS = 4
ENTRIES = 256
ROUNDS = 4
DEGREE = 12
LEAF = 10
SLACK = 1e-9
BATCH_ROWS = 4_096


@dataclass
class Node:
    """Entries that are compared here, and the children with their distance ranges."""
    points: np.ndarray                       # entry indices, ascending
    children: list[Node | None]              # one per point; a leaf has none
    low: np.ndarray | None = None            # point x child
    high: np.ndarray | None = None


class Gnat:
    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF) -> None:
        self.entries, self.degree, self.leaf = entries, degree, leaf
        self.evaluations = 0
        self.root = self._build(np.arange(len(entries)))

    def _build(self, members: np.ndarray) -> Node:
        if len(members) <= max(self.leaf, self.degree):
            return Node(members, [])
        # Split points: the first member, then always the one furthest from those chosen.
        chosen = [0]
        apart = squared_distances(self.entries[members], self.entries[members[:1]])[:, 0]
        while len(chosen) < self.degree and apart.max() > 0:
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, squared_distances(self.entries[members], self.entries[members[chosen[-1:]]])[:, 0])
        points = np.sort(members[chosen])
        rest = np.setdiff1d(members, points)
        squared = squared_distances(self.entries[rest], self.entries[points])
        if len(points) == 1:                 # all members are equal: the lowest index wins
            return Node(points, [])
        away, home = np.sqrt(squared.astype(np.float64)), squared.argmin(axis=1)
        low = np.full((len(points), len(points)), np.inf)
        high = np.full((len(points), len(points)), -np.inf)
        children: list[Node | None] = []
        for j in range(len(points)):
            mine = home == j
            if mine.any():
                low[:, j], high[:, j] = away[mine].min(axis=0), away[mine].max(axis=0)
            children.append(self._build(rest[mine]) if mine.any() else None)
        return Node(points, children, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, exact squared distance) of the nearest entry, the lower index among equals."""
        who = np.full(len(queries), len(self.entries), dtype=np.int64)
        best = np.full(len(queries), np.iinfo(np.int64).max)
        if len(queries):
            self._visit(self.root, queries, np.arange(len(queries)), who, best)
        return who, best

    def _visit(self, node: Node, queries: np.ndarray, rows: np.ndarray, who: np.ndarray, best: np.ndarray) -> None:
        squared = squared_distances(queries[rows], self.entries[node.points])
        self.evaluations += squared.size
        at = squared.argmin(axis=1)
        least, index = squared[np.arange(len(rows)), at], node.points[at]
        better = (least < best[rows]) | (least == best[rows]) & (index < who[rows])
        best[rows[better]], who[rows[better]] = least[better], index[better]
        if not node.children:
            return
        away = np.sqrt(squared.astype(np.float64))
        for own in (True, False):
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                at_child = np.flatnonzero((at == j) == own)
                if not len(at_child):
                    continue
                d, radius = away[at_child], np.sqrt(best[rows[at_child]].astype(np.float64))[:, None]
                short = np.maximum(d - node.high[:, j], node.low[:, j] - d)
                out = (short > radius + SLACK * (d + node.high[:, j] + radius)).any(axis=1)
                at_child = at_child[~out]
                if len(at_child):
                    self._visit(child, queries, rows[at_child], who, best)


def _sums(books: list[np.ndarray]):
    """Per task: counts and sums of the parts nearest to each entry."""
    parts, width = len(books), books[0].shape[1]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros(b.shape, dtype=np.int64) for b in books]
        for batch in batches(rows, BATCH_ROWS):
            x = matrix(batch.column(0), parts * width)
            for p in range(parts):
                mine = x[:, p * width:(p + 1) * width]
                entry = trees[p].nearest(mine)[0]
                counts[p] += np.bincount(entry, minlength=len(counts[p]))
                np.add.at(sums[p], entry, mine)
        for p in range(parts):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used]),
                 pa.array(list(sums[p][used]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])
    return run


def _coded(books: list[np.ndarray]):
    parts, width = len(books), books[0].shape[1]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches(rows, BATCH_ROWS):
            x = matrix(batch.column(1), parts * width)
            codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                codes[:, p], squared = trees[p].nearest(x[:, p * width:(p + 1) * width])
                error += squared
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), *batch.columns[2:]],
                names=["id", "code", "error", *batch.schema.names[2:]])
    return run


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """One codebook per part position from ``(id, v)``, whose vectors all have one length."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte per part: 1 to 256 entries")
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return []
    start = np.array([r["v"] for r in first], dtype=np.int64)
    width = start.shape[1] // parts
    books = [start[:, p * width:(p + 1) * width] for p in range(parts)]
    for _ in range(rounds):
        found = vectors.select("v").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>") \
            .groupBy("part", "entry").agg(F.sum("n").alias("n"), *(
                F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
        books = [b.copy() for b in books]
        for r in found.collect():            # at most parts x entries rows
            books[r["part"]][r["entry"]] = floor_mean(r[3:], r["n"])
    return books


def encode(vectors: DataFrame, books: list[np.ndarray], carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, code binary, error long, *carry)`` of ``(id, v, *carry)``."""
    schema = "id long, code binary, error long" + "".join(
        f", `{c}` {vectors.schema[c].dataType.simpleString()}" for c in carry)
    return vectors.select("id", "v", *carry).mapInArrow(_coded(books), schema)


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, code string, error, label_error, codebooks_sha256)`` per vector."""
    spark = table.sparkSession
    # Under a name of its own a label of any name meets no other column.
    rows = integer_vectors(table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("x"), F.col(label_col).alias("label")),
                           "id", "x", carry=("label",))
    fitting = rows.filter((F.size("v") > 0) & (F.size("v") % parts == 0))
    least = fitting.orderBy(F.col("id").asc_nulls_last(), "v").select(F.size("v").alias("n")).limit(1).collect()
    size = least[0]["n"] if least else 0
    same = rows.filter(F.size("v") == size) if size else rows.filter("false")
    books = train(same.select("id", "v"), parts, entries, rounds)
    none = (rows.filter(F.size("v") != size) if size else rows).select(
        "id", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"), "label")
    coded = cut(encode(same, books, carry=("label",)).union(none) if books else none, "codes")
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    name = digest(int(v) for book in books for v in book.reshape(-1)) if books else None
    return coded.join(errors, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(name).cast("string").alias("codebooks_sha256"))
