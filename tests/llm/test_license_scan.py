import random
import re
import time

from quorum.llm import license_scan
from quorum.llm.license_scan import CONTAINED, TEMPLATES, scan
from tests.llm.helpers import docs, prose


def grams(text):
    words = re.findall(r"[^\W_]+", text.lower())
    return [tuple(words[i:i + 3]) for i in range(len(words) - 2)]


def brute(text):
    """Licenses of which some part of the text of about the template's length holds enough."""
    own, out = grams(text or ""), {}
    for name, template in TEMPLATES:
        want = set(grams(template))
        for start in range(len(own)):
            share = len(want & set(own[start:start + 2 * len(want) + 6])) / len(want)
            if share >= CONTAINED:
                out[name] = max(share, out.get(name, 0))
    return out


def corpus():
    rng = random.Random(7)
    rows = []
    for i in range(300):
        parts = prose(rng, rng.randrange(0, 300), 3000)
        for _ in range(rng.randrange(0, 3)):
            notice = rng.choice(TEMPLATES)[1].split()
            kind = rng.random()
            if kind < 0.2 and len(notice) > 15:
                notice[rng.randrange(len(notice))] = "changed"
            elif kind < 0.35:
                notice = notice[:len(notice) // 2]
            elif kind < 0.5:
                notice = [w.upper() for w in notice]
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = notice
        rows.append((i, rng.choice([" ", "\n", " * "]).join(parts)))
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    got = {r.id: {m.license: m.containment for m in r.matches} for r in scan(docs(spark, rows)).collect()}
    want = {i: brute(t) for i, t in rows}
    assert sum(map(len, want.values())) > 150
    # Retrieval is by MinHash: nothing wrong, and next to nothing missed.
    missed = sum(len(want[i].keys() - got[i].keys()) for i in want)
    assert missed <= 1
    for i in want:
        assert got[i].keys() <= want[i].keys()
        assert all(got[i][k] <= want[i][k] + 1e-12 for k in got[i])


def test_whole_texts_and_long_runs_of_notices(spark):
    """Every template within prose, reflowed as comments, and a megabyte of notices."""
    rng = random.Random(9)
    rows = [(i, " ".join(prose(rng, 40, 3000)) + "\n# " + text.replace("\n", "\n# ") + "\n" + " ".join(prose(rng, 40, 3000)))
            for i, (_, text) in enumerate(TEMPLATES)]
    rows.append((99, "\n".join(f"{i} " + TEMPLATES[i % 19][1] for i in range(10_000))))
    began = time.monotonic()
    got = {r.id: {m.license: m.containment for m in r.matches} for r in scan(docs(spark, rows)).collect()}
    assert time.monotonic() - began < 60
    assert all(got[i].get(name) == 1.0 for i, (name, _) in enumerate(TEMPLATES))
    assert got[99].keys() == {name for name, _ in TEMPLATES[:19]}


def test_bands_are_the_only_retrieval(spark):
    """A template whose bands hold nothing is not found, whatever shingles it shares; five words are."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    passages = [rng.sample(words, 5) for _ in range(400)]
    rows = [(i, " ".join(rng.sample(words, rng.randrange(3, 9)) + p + rng.sample(words, 9))) for i, p in enumerate(passages)]
    found = 0
    for at in range(0, 400, 100):
        templates = tuple((f"t{i}", " ".join(passages[i])) for i in range(at, at + 100))
        got = scan(docs(spark, rows[at:at + 100]), templates=templates).collect()
        found += sum(f"t{r.id}" in [m.license for m in r.matches] for r in got)
    assert found >= 397         # 0.999 each
    empty = [{} for _ in range(license_scan.BANDS)]
    whole = license_scan.template_index
    try:
        license_scan.template_index = lambda *a: (whole(*a)[0], empty)
        assert scan(docs(spark, [(1, TEMPLATES[0][1])])).collect()[0].matches == []
    finally:
        license_scan.template_index = whole


def test_only_expressions(spark):
    plan = scan(docs(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange|Join", plan)


def test_defined_cases(spark):
    notice = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, "a b"), (None, notice), (4, notice), (4, notice), (5, "…\n" + notice + "é " * 300_000),
            (6, notice + " " + notice)]
    df = docs(spark, rows).selectExpr("*", "1 as hs", "2 as id", "3 as matches")
    got = sorted(((r.id, [(m.license, m.containment, m.start) for m in r.matches], r.lang) for r in
                  scan(df, carry=("lang",)).collect()), key=str)
    hit = [("MIT", 1.0, 0)]
    assert got == sorted([(1, [], "en"), (2, [], "en"), (3, [], "en"), (None, hit, "en"), (4, hit, "en"), (4, hit, "en"),
                          (5, hit, "en"), (6, hit, "en")], key=str)
    assert scan(docs(spark, [])).collect() == []
    assert scan(docs(spark, rows), templates=(("X", "two words"),)).filter("size(matches) > 0").count() == 0
