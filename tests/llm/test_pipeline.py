import random

import pytest
import sentencepiece

import corpus_pipeline
from quorum.llm import piece_stream
from tests.llm.helpers import docs, prose
from tests.llm.test_minhash_forest import brute as brute_groups
from tests.llm.test_suffix_runs import WINDOW


def corpus():
    rng = random.Random(9)
    insults = ["blarg", "zorgon", "vexil"]
    bench = [(i, " ".join(prose(rng, 30, 5000))) for i in range(6)]
    passage = " ".join(prose(rng, 70, 5000))
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randrange(30, 90), 3000)
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        elif i % 17 == 1:
            words = words[:20] + [passage] + words[20:]
        elif i % 31 == 2:
            words = words[:10] + [bench[i % 6][1]] + words[10:]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    clean = [r for r in rows if r[0] % 5]
    rows += [(1000 + i, clean[i][1] + " tail") for i in range(25)] + [(1100, clean[3][1]), (1101, "short"), (1102, None), (1103, ""), (1101, "short")]
    return rows, labels, bench


def toxic(text):
    return any(w in (text or "") for w in ("blarg", "zorgon", "vexil"))


def brute(rows, bench):
    rows = [r for r in rows if not toxic(r[1])]
    # Near duplicates: the least id of a group, one row of an id.
    kept = {i for i, _, _, own in brute_groups(rows, 5) if own}
    rows = sorted({(i, t) for i, t in rows if i in kept}, key=str)
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - WINDOW + 1):
            w = raw[p:p + WINDOW]
            first[w] = min(first.get(w, i), i)
    cut = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - WINDOW + 1):
            if first[raw[p:p + WINDOW]] < i:
                gone[p:p + WINDOW] = b"\1" * WINDOW
        cut.append((i, bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")))
    rows = [(i, t) for i, t in cut if not any(b in t for _, b in bench)]
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_stream.MODEL)
    return {i: lib.encode(t) for i, t in rows}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, labels, bench = corpus()
    folder = str(tmp_path_factory.mktemp("tables"))
    docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, bench


def test_matches_brute_force(spark, tables):
    folder, rows, bench = tables
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    want = brute(rows, bench)
    assert got.keys() == want.keys()
    assert all(got[i].ids == want[i] and got[i].n_tokens == len(want[i]) and got[i].round_trip for i in want)


def test_stages_on_empty_tables_nulls_and_extra_columns(spark, tables):
    folder, _, _ = tables
    base = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs(spark, [(None, "one text of nobody"), (None, None), (1, None), (1, None), (2, "x " * 100_000), (3, "")]) \
        .selectExpr("*", "1 as row", "2 as id", "3 as kept", "'q' as matches")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, base.limit(0), folder).collect() == [], name
        out = stage(spark, odd, folder)
        assert out.count() == (5 if name == "near_duplicates" else 6), name
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
