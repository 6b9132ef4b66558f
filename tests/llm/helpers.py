"""Small tables for the operator tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def smallest_reachable(nodes: list[int], links: list[tuple[int, int]]) -> dict[int, int]:
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label
