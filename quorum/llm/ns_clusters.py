"""Centroid clustering of integer vectors with ns-bounds.

Lloyd's rounds on exact integers, in which most distances are never taken.  Per vector and
centroid the state keeps the last exact squared distance and the round it was taken in; the
driver keeps the centroids of all rounds (rounds x k x size integers, all parameters).  In a
later round a stored distance is loosened by the norm of the centroid's *total* displacement
since that round, |c(now) - c(then)|, which is never more than the sum of its steps:

    distance to own centroid   <= stored + displacement     (upper bound)
    distance to another        >= stored - displacement     (lower bound)

A vector whose every lower bound lies strictly above its upper bound stays where it is, without
an evaluation.  Otherwise its own distance is taken anew, and then exactly those centroids whose
bound still fails.  The tests round against skipping, and a tie is no skip, so the assignment is
that of full rescans; exact integers decide, ties go to the smaller number.

On Spark: one pass per round over the state table (``mapInArrow``, no shuffle), written to the
shared folder; a table is deleted once the round after it is written.  Centroid sums are kept up
to date from the vectors that changed their cluster: signed sums per cluster with map-side
partial aggregation, k rows reach the driver.  A cluster may hold any share of the rows.  Rounds
end early when no vector moves, since all later rounds would repeat.

Defined cases: vectors that are null, hold null or non-finite components or another number of
components are not kept; repeated rows and ids are vectors of their own; a null id comes last
among the hashes that start centroids; fewer vectors than k give as many centroids; an empty table gives an
empty result; further columns are ignored.  The table holds no texts.  Sums of a component over
a cluster must fit 64 bits (at most 1e15 rows of components up to 8).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import batches, cut_at, discard
from quorum.llm.integer_vectors import digest, floor_mean, integer_vectors, lists, matrix, squared_distances, squared_pairs

BATCH_ROWS = 4_096
SLACK = 1e-9
_STATE = "id long, v array<int>, was int, own int, near array<long>, taken array<int>, evaluations int"


def first_assignment(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own, near, taken) of round 0: every distance."""
    near = squared_distances(x, centers)
    return near.argmin(axis=1).astype(np.int32), near, np.zeros(near.shape, dtype=np.int32)


def reassign(x: np.ndarray, own: np.ndarray, near: np.ndarray, taken: np.ndarray, history: np.ndarray,
             settle: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(own, evaluations) under the last centroids of ``history``; near and taken are updated.

    ``settle`` takes every vector's distance to its own centroid, whatever the bounds say.
    """
    now, k = len(history) - 1, history.shape[1]
    centers, rows = history[now], np.arange(len(x))
    gap = history - centers
    moved = np.sqrt((gap * gap).sum(axis=2, dtype=np.int64).astype(np.float64))     # round x centroid
    evaluations = np.zeros(len(x), dtype=np.int32)

    def evaluate(at: np.ndarray, c: np.ndarray) -> None:
        near[at, c] = squared_pairs(x[at], centers[c])
        taken[at, c] = now
        np.add.at(evaluations, at, 1)

    def failing(at: np.ndarray) -> np.ndarray:
        stored = np.sqrt(near[at].astype(np.float64))
        loose = moved[taken[at], np.arange(k)]
        mine = np.arange(len(at)), own[at]
        upper = (stored[mine] + loose[mine])[:, None]
        fails = stored - loose <= upper + SLACK * (stored + loose + upper)
        fails[mine] = False
        return fails

    todo = np.flatnonzero(failing(rows).any(axis=1))
    again = rows if settle else todo
    again = again[taken[again, own[again]] != now]
    evaluate(again, own[again])
    if len(todo):
        fails = failing(todo) & (taken[todo] != now)
        at, c = np.nonzero(fails)
        evaluate(todo[at], c)
        exact = np.where(taken[todo] == now, near[todo], np.iinfo(np.int64).max)
        own = own.copy()
        own[todo] = exact.argmin(axis=1)
    return own, evaluations


def _start(centers: np.ndarray):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, BATCH_ROWS):
            x = matrix(batch.column(1), centers.shape[1])
            own, near, taken = first_assignment(x, centers)
            yield _rows(batch.column(0), x, pa.nulls(len(x), pa.int32()), own, near, taken, np.full(len(x), len(centers), np.int32))
    return run


def _next(history: np.ndarray, settle: bool):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = history.shape[1:]
        for batch in batches(rows, BATCH_ROWS):
            x, was = matrix(batch.column(1), width), batch.column(3).to_numpy()
            near, taken = matrix(batch.column(4), k), matrix(batch.column(5), k).astype(np.int32)
            own, evaluations = reassign(x, was, near, taken, history, settle)
            yield _rows(batch.column(0), x, pa.array(was), own, near, taken, evaluations)
    return run


def _rows(ids, x, was, own, near, taken, evaluations) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, lists(x, pa.int32()), was, pa.array(own), lists(near, pa.int64()), lists(taken, pa.int32()), pa.array(evaluations)],
        names=["id", "v", "was", "own", "near", "taken", "evaluations"])


def _changes(state: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """Per cluster the change of its count and sums in the last pass: at most k rows."""
    moved = state.filter("was is null or own <> was") \
        .select("v", F.explode(F.array(F.struct(F.col("own").alias("c"), F.lit(1).alias("sign")),
                                       F.struct(F.col("was").alias("c"), F.lit(-1).alias("sign")))).alias("e")) \
        .select("v", "e.c", "e.sign").filter("c is not null")
    sums = moved.groupBy("c").agg(F.sum("sign").alias("n"), *(
        F.sum(F.col("sign") * F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(width)))
    return {r["c"]: (int(r["n"]), [int(s) for s in r[2:]]) for r in sums.collect()}


def cluster(vectors: DataFrame, k: int = 8, size: int = 64, rounds: int = 10, salt: str = "3",
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256, evaluations)`` per vector.

    ``evaluations``: distances of the vector taken in the last assignment.
    """
    spark = vectors.sparkSession
    kept = integer_vectors(vectors.filter(F.size(F.col(vec_col)) == size), id_col, vec_col)
    first = kept.select(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).alias("h"), "v") \
        .orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string, evaluations int")
    history = np.array([[r["v"] for r in first]], dtype=np.int64)
    counts, sums = [0] * len(first), [[0] * size for _ in first]
    state, path = cut_at(kept.mapInArrow(_start(history[0]), _STATE), "ns-state")
    for now in range(1, rounds + 1):
        changes = _changes(state, size)
        if not changes:
            break
        for c, (n, by) in changes.items():
            counts[c] += n
            sums[c] = [a + b for a, b in zip(sums[c], by, strict=True)]
        centers = [floor_mean(s, n) if n else list(old) for s, n, old in zip(sums, counts, history[-1], strict=True)]
        history = np.concatenate([history, np.array([centers], dtype=np.int64)])
        before = path
        state, path = cut_at(state.mapInArrow(_next(history, settle=now == rounds), _STATE), "ns-state")
        discard(spark, before)
    # An early end, or no round at all, leaves older distances among the stored ones.
    settled = state if rounds and len(history) == rounds + 1 else \
        cut_at(state.mapInArrow(_next(history, settle=True), _STATE), "ns-state")[0]
    found = settled.select("id", F.col("own").alias("cluster"), F.element_at("near", F.col("own") + 1).alias("distance"), "evaluations")
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    per = F.array(*(F.lit(inertia.get(c, 0)).cast("long") for c in range(len(first))))
    names = F.array(*(F.lit(digest(c)) for c in history[-1]))
    return found.select("id", "cluster", "distance", F.element_at(per, F.col("cluster") + 1).alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
                        F.element_at(names, F.col("cluster") + 1).alias("centroid_sha256"), "evaluations")
