import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorum.llm import toxicity_grammar as g
from tests.llm.helpers import docs, prose


def test_composition_equals_running_the_transducers_in_turn():
    chain = [g.reported_speech(), g.negation(), g.target()]
    rng = random.Random(2)
    inputs = list(itertools.product(range(9), repeat=3)) + [[rng.randrange(9) for _ in range(30)] for _ in range(300)]
    for symbols in inputs:
        want = list(symbols)
        for machine in chain:
            want = g.run(machine, want)
        assert g.run(g.GRAMMAR, symbols) == want


@pytest.mark.parametrize("text,label", [
    ("You are an idiot.", "insult_addressed"), ("idiot", "insult"), ("the idiot and the idiot", "insults"),
    ("he is not an idiot", "denied_addressed"), ("She said idiot.", "reported_addressed"),
    ('the word "idiot" again', "reported"), ("I will kill you!", "threat_addressed"), ("not kill", "denied"),
    ("du idiotin", "insult_addressed"), ("IDIOT!", "insult"), ("said. idiot", "insult")])
def test_clause_labels(text, label):
    scorer = g.Scorer({b"idiot"}, {b"idioti"})
    assert dict(zip(g.LABELS, scorer.counts(text.encode()))) == {x: float(x == label) for x in g.LABELS}


def test_words_without_a_clause_match_add_nothing():
    scorer = g.Scorer({b"idiot"}, set())
    for text in (None, b"", b"you and them", b"idiots idio", b'"not" said', "é".encode() * 9, b"\0 \xff"):
        assert not scorer.counts(text).any()
    assert scorer.counts(b"idiot. fine. idiot\nyou")[g.LABELS.index("insult")] == 2


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_learns_words_and_stems_and_generalises(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = prose(rng, 60, 300)
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(60), rng.choice(["blarg", f"zorgu{rng.choice('abcdefgh')}{rng.choice('xyz')}"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    copy = "uniqueword " + " ".join(prose(rng, 80)) + " blarg"
    rows += [(1000 + i, copy) for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    rows += [(2000, None), (2001, ""), (None, "blarg blarg"), (None, None), (2002, "x " * 200_000 + "zorguqq.")]
    labels += [(2000, 1), (None, 1), (3, None), (5, 0), (5, 0), (77777, 1)]
    df = docs(spark, rows).withColumn("label", F.lit(9)).withColumn("score", F.lit("s"))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    scorer, weights = model = g.fit(df, table, g.held_out("doc", 5, 0))
    assert b"blarg" in scorer.insults.words and not {b"uniqueword"} & scorer.insults.words
    got = {}
    for r in g.score(df, model, carry=("lang",)).collect():
        got.setdefault(r.id, []).append(r.score)
    held = [(i, t) for i, t in labels[:900] if fold(i)]
    assert np.mean([(got[i][0] >= 0.5) == t for i, t in held]) > 0.98
    assert got[2000] == got[2001] and got[2000][0] < 0.5 and got[2002][0] >= 0.5
    assert max(got[None]) >= 0.5 and len(got[None]) == 2


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = g.fit(docs(spark, [(1, "a b")]), none, g.held_out("doc", 5, 0))
    got = g.score(docs(spark, [(1, "I will kill you"), (2, "hello")]), model).collect()
    assert [r.score > 0.2 for r in sorted(got)] == [True, False]
    assert g.score(docs(spark, []), model).collect() == []


def test_rows_that_share_a_passage_all_count(spark, monkeypatch):
    """Only equal sets of shingles of one label collapse, not rows that share a passage."""
    rng = random.Random(6)
    passage = " ".join(prose(rng, 60, 5000))
    rows = [(i, passage + " " + " ".join(prose(rng, 30, 5000))) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(5)] + [(200, rows[0][1])]
    labels = [(i, i % 2) for i in range(40)] + [(100 + i, 0) for i in range(5)] + [(200, 1)]
    kept = []
    monkeypatch.setattr(g, "cut", lambda df, name: kept.append(df) or df)
    g.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(False))
    assert sorted(r.doc for r in kept[0].collect()) == [*range(40), 200]
