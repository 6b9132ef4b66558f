"""Quality scores: random Fourier features over document statistics, ridge, isotonic.

A text becomes a vector of statistics of its bytes, words and lines.  Standardised, its
random cosines approximate a Gaussian kernel; each partition sums the products of the ridge
regression's normal equations by fold and Spark adds the sums, so the driver solves systems of
a fixed size: one of all rows, whose weights score, and one of the rows outside each fold.  The
latter give every training row an output that has not seen it, and isotonic regression of the
labels on these outputs, over a fixed grid, calibrates the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import binaries, cut
from quorum.llm.shingles import word_hashes
from quorum.llm.toxicity_grammar import training_rows

TRAIN_ROWS = 60_000
FEATURES = 192
RIDGE = 1e-3
WIDTH = 3.0         # of the Gaussian kernel over standardised statistics
GRID = 512
FOLDS = 5
SEED = 20240229

_KIND = np.full(256, 6, dtype=np.uint8)                 # 6: other control and symbol bytes
_KIND[0x61:0x7B] = 0                                    # lower case
_KIND[0x41:0x5B] = 1                                    # upper case
_KIND[0x30:0x3A] = 2                                    # digits
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3               # spaces
_KIND[0x0A] = 4
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 5             # punctuation
_KIND[0x80:] = 7                                        # other scripts and accents
N_STATS = 20


def statistics(text: bytes | None) -> np.ndarray:
    """Statistics of a whole text; zeros for a null or empty one."""
    out = np.zeros(N_STATS)
    if not text:
        return out
    n = len(text)
    share = np.bincount(_KIND[np.frombuffer(text, dtype=np.uint8)], minlength=8) / n
    words = word_hashes(text)
    m = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[0], out[1] = np.log1p(n), np.log1p(m)
    out[2:10] = share
    out[10] = np.log1p(n / max(1, m))
    if m:
        counts = np.unique(words, return_counts=True)[1]
        p = counts / m
        out[11] = len(counts) / m
        out[12] = counts.max() / m
        out[13] = -(p * np.log(p)).sum() / np.log(m + 1)
        out[14] = (words[1:] == words[:-1]).mean() if m > 1 else 0.0
        pairs = words[1:] * np.uint64(0x9E3779B97F4A7C15) + words[:-1]
        out[15] = len(np.unique(pairs)) / len(pairs) if m > 1 else 1.0
    out[16] = np.log1p(len(lines))
    out[17] = len(set(lines)) / max(1, len(lines))
    out[18] = text.count(b".") / max(1, m)
    out[19] = text.count(b"|") / max(1, m)
    return out


class Fourier:
    """Standardising and the random cosines; the last feature is the constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.direction = rng.normal(0, 1 / WIDTH, (N_STATS, FEATURES))
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.deviation, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.direction + self.phase), np.ones((len(z), 1))])


def isotonic(values: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending values: (knots, probabilities), smoothed by one
    half of a row of each label per block."""
    blocks: list[list[float]] = []      # weight, ones, sum of values * weight
    for v, a, b in zip(values, ones, zeros, strict=True):
        if a + b == 0:
            continue
        blocks.append([a + b, a, v * (a + b)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, a2, s = blocks.pop()
            blocks[-1][0] += w
            blocks[-1][1] += a2
            blocks[-1][2] += s
    knots = np.array([s / w for w, _, s in blocks])
    found = np.array([(a + 0.5) / (w + 1) for w, a, _ in blocks])
    return knots, np.maximum.accumulate(found)


class Model:
    def __init__(self, fourier: Fourier, weights: np.ndarray, knots: np.ndarray, levels: np.ndarray) -> None:
        self.fourier, self.weights, self.knots, self.levels = fourier, weights, knots, levels

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        stats = np.array([statistics(t) for t in texts]).reshape(len(texts), N_STATS)
        if not len(self.knots):
            return np.full(len(texts), 0.5)
        return np.interp(self.raw(stats), self.knots, self.levels)


def _statistics(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        found = [statistics(t) for t in binaries(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))],
                                         names=["doc", "label", "x"])


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fold, label, statistics) of a batch of training rows."""
    x = np.array(batch.column("x").to_pylist(), dtype=float).reshape(batch.num_rows, N_STATS)
    return batch.column("fold").to_numpy(), batch.column("label").to_numpy().astype(float), x


def _normal_equations(fourier: Fourier):
    """The partition's sums by fold: the upper triangle of X'X, and X'y as one more column."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = FEATURES + 1
        total = np.zeros((FOLDS, d, d + 1))
        for batch in rows:
            fold, y, stats = _columns(batch)
            x = fourier(stats)
            for f in np.unique(fold):
                own = fold == f
                total[f] += x[own].T @ np.hstack([x[own], y[own, None]])
        i, j = np.triu_indices(d, 0, d + 1)
        for f in range(FOLDS):
            if total[f].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), f, dtype=np.int32)), pa.array(i.astype(np.int32)),
                     pa.array(j.astype(np.int32)), pa.array(total[f, i, j])], names=["fold", "i", "j", "v"])
    return run


def solve(total: np.ndarray) -> np.ndarray:
    """Ridge weights of summed normal equations (X'X with X'y as its last column)."""
    d = FEATURES + 1
    upper = np.triu(total[:, :d])
    return np.linalg.solve(upper + np.triu(upper, 1).T + RIDGE * max(1.0, total[d - 1, d - 1]) * np.eye(d), total[:, d])


def _outputs(fourier: Fourier, weights: np.ndarray):
    """The grid cell of each training row's output, by the weights that have not seen its fold."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            fold, _, stats = _columns(batch)
            raw = (fourier(stats) * weights[fold]).sum(axis=1)
            cell = np.clip(np.round((raw + 0.5) / 2 * GRID), 0, GRID)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column("label")],
                                             names=["cell", "label"])
    return run


def fold_of(column: str) -> Column:
    return (F.crc32(F.concat(F.lit("calibration "), F.col(column).cast("string")).cast("binary")) % FOLDS).cast("int")


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, limit: int = TRAIN_ROWS) -> Model:
    """The model from the labelled rows outside the held-out fold (a condition on ``doc``).

    With rows of one label only, or none, every score is 0.5.
    """
    rows = cut(training_rows(docs, labels, "quality", held_out, limit)
               .mapInArrow(_statistics, "doc long, label int, x array<double>")
               .withColumn("fold", fold_of("doc")), "statistics")
    moments = rows.select("label", F.posexplode("x").alias("j", "v")).groupBy("j") \
        .agg(F.count("*").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s"),
             F.sum("label").alias("ones")).orderBy("j").collect()
    empty = Model(Fourier(np.zeros(N_STATS), np.ones(N_STATS)), np.zeros(FEATURES + 1), np.empty(0), np.empty(0))
    if not moments or not 0 < moments[0]["ones"] < moments[0]["n"]:
        return empty
    fourier = Fourier(np.array([r["m"] for r in moments]), np.array([r["s"] for r in moments]))
    sums = rows.mapInArrow(_normal_equations(fourier), "fold int, i int, j int, v double") \
        .groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).collect()
    d = FEATURES + 1
    total = np.zeros((FOLDS, d, d + 1))
    for fold, i, j, v in sums:
        total[fold, i, j] = v
    whole = total.sum(axis=0)
    unseen = np.array([solve(whole - own) for own in total])
    cells = rows.mapInArrow(_outputs(fourier, unseen), "cell int, label int").groupBy("cell", "label").count().collect()
    counts = np.zeros((2, GRID + 1))
    for r in cells:
        counts[r["label"], r["cell"]] = r["count"]
    return Model(fourier, solve(whole), *isotonic(np.arange(GRID + 1) / GRID * 2 - 0.5, counts[1], counts[0]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, score, *carry)`` per row, from the whole text alone.

    A null text counts as empty, and an empty one has all statistics zero and a score like
    any other; a very long text is read whole, with a few times its size in memory.  Equal texts
    have equal scores.  Null ids, repeated rows, an empty table and further columns are fine.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       *(F.col(c) for c in carry))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(binaries(batch.column(1)))),
                                              *batch.columns[2:]], names=["id", "score", *batch.schema.names[2:]])

    schema = "id long, score double" + "".join(f", `{c}` {base.schema[c].dataType.simpleString()}" for c in carry)
    return base.mapInArrow(run, schema)

