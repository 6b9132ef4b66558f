"""Toxicity scores by a weighted finite-state grammar over clauses.

Three sequential transducers read the classes of a clause's tokens: reported speech marks
insults and threats that are quoted, negation marks those it denies, and the target
transducer gathers what the clause holds and whether someone is addressed, and writes one
label at the clause's end.  They are composed once into one table; a document's score is a
logistic function of its clauses' labels.  A word outside a matched clause adds nothing.

What is learned, from at most ``TRAIN_ROWS`` labelled rows (by hash order): the insult
lexicon, whole words and stems whose association with the label passes a likelihood-ratio
test corrected for the number of candidates (words that clean rows hold now and then are
mild ones), and the weight of each clause label, by ridge
regression towards the grammar's own prior weights.  Training rows of one label with equal
sets of shingles count once; all others count.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import batches, binaries, cut, tidy
from quorum.llm.shingles import _POWERS, mix, shingle_set

TRAIN_ROWS = 30_000
LEXICON_TERMS = 5_000
STEM_BYTES = (4, 5, 6, 7, 8)
STEM_WORDS = 3
PURITY = 50         # toxic rows per clean row of a stem, or of a word that is more than mild

# Closed word classes of the grammar (English, German, French, Spanish).
THREATS = ("kill", "hurt", "destroy", "beat", "shoot", "stab", "töten", "umbringen", "schlagen", "tuer", "frapper",
           "détruire", "matar", "golpear", "destruir")
TARGETS = ("you", "your", "yourself", "he", "she", "they", "them", "him", "her", "those", "du", "dich", "dir", "ihr",
           "euch", "sie", "tu", "toi", "vous", "ils", "elles", "usted", "ustedes", "ellos", "ellas", "vosotros")
NEGATIONS = ("not", "no", "never", "nobody", "isn", "aren", "don", "won", "nicht", "kein", "keine", "nie", "niemals",
             "ne", "pas", "jamais", "aucun", "nunca", "jamás", "ningún")
REPORTS = ("said", "says", "wrote", "called", "quoted", "reported", "according", "sagte", "schrieb", "nannte", "dit",
           "écrit", "appelé", "selon", "dijo", "escribió", "llamó", "según")

# Token classes; a mild insult is a learned word that clean rows hold now and then.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END, MILD = range(9)
# Symbols between the transducers: reported and denied forms.
REPORTED, DENIED = 9, 10
KINDS = ("none", "denied", "reported", "mild", "insult", "insults", "threat")
LABELS = tuple(f"{kind}{who}" for kind in KINDS[1:] for who in ("", "_addressed"))
# Prior weights on the logistic scale, for each kind: a clause of it, and that it is addressed.
PRIOR = (0.0, 0.2, 0.3, 0.3, 1.0, 0.5, 2.0, 1.0, 3.0, 1.0, 2.0, 2.0)

_TOKEN = re.compile(rb"[a-z\x80-\xff]+|[.!?;:\n]|\"")
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def reported_speech() -> dict:
    """States: plain, reported (to the end of the clause), quoted (to the next quote mark)."""
    arcs = {}
    for state in range(3):
        for symbol in range(9):
            to, out = state, symbol
            if symbol == REPORT and state == 0:
                to = 1
            elif symbol == QUOTE:
                to, out = (0 if state == 2 else 2), OTHER
            elif symbol == END and state == 1:
                to = 0
            if state and symbol in (INSULT, THREAT, MILD):
                out = REPORTED
            arcs[state, symbol] = to, out
    return arcs


def negation(reach: int = 3) -> dict:
    """States: tokens that a negation still reaches."""
    arcs = {}
    for state in range(reach + 1):
        for symbol in range(10):
            to, out = max(0, state - 1), symbol
            if symbol == NEGATION:
                to = reach
            elif symbol == END:
                to = 0
            if state and symbol in (INSULT, THREAT, MILD):
                out = DENIED
            arcs[state, symbol] = to, out
    return arcs


def target() -> dict:
    """States: 2 * kind + addressed; writes a clause label at the clause's end.

    Two mild insults make one, and an insult beside any other makes several."""
    rank = {DENIED: 1, REPORTED: 2, MILD: 3, INSULT: 4, THREAT: 6}
    joint = {(3, MILD): 4, (3, INSULT): 5, (4, MILD): 5, (4, INSULT): 5, (5, MILD): 5, (5, INSULT): 5}
    arcs = {}
    for kind in range(len(KINDS)):
        for addressed in range(2):
            for symbol in range(11):
                k, a, out = kind, addressed, -1
                if symbol == END:
                    out = 2 * (kind - 1) + addressed if kind else -1
                    k = a = 0
                elif symbol == TARGET:
                    a = 1
                elif symbol in rank:
                    k = joint.get((kind, symbol), max(kind, rank[symbol]))
                arcs[2 * kind + addressed, symbol] = 2 * k + a, out
    return arcs


def compose(first: dict, second: dict) -> dict:
    """The transducer that feeds the first one's output to the second, states renumbered."""
    symbols = sorted({symbol for _, symbol in first})
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        a, b = pair = todo.pop()
        for symbol in symbols:
            a2, middle = first[a, symbol]
            b2, out = second[b, middle]
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            arcs[number[pair], symbol] = number[a2, b2], out
    return arcs


GRAMMAR = compose(compose(reported_speech(), negation()), target())


def run(arcs: dict, symbols) -> list[int]:
    state, out = 0, []
    for symbol in symbols:
        state, written = arcs[state, symbol]
        out.append(written)
    return out


_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Lexicon:
    """Finds the words of a text that are in a word list or begin with a stem."""

    def __init__(self, words: set[bytes], stems: set[bytes]) -> None:
        self.words, self.stems = words, stems
        self.word_hashes = np.sort(np.array([self._hash(w) for w in words], dtype=np.uint64))
        self.stem_hashes = {n: np.sort(np.array([self._hash(s) for s in stems if len(s) == n], dtype=np.uint64))
                            for n in sorted({len(s) for s in stems})}

    @staticmethod
    def _sums(raw: np.ndarray):
        up, down = _POWERS.get(len(raw) + 1)
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return total, down

    def _hash(self, word: bytes) -> np.uint64:
        total, _ = self._sums(np.frombuffer(word, dtype=np.uint8))
        return mix(total[-1:])[0]

    def holds(self, word: bytes) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in self.stem_hashes)

    def hits(self, text: bytes) -> np.ndarray:
        """Start offsets of the words found (a superset by hashing; ``holds`` confirms)."""
        raw = np.frombuffer(text, dtype=np.uint8)
        letter = np.zeros(len(raw) + 2, dtype=bool)
        letter[1:-1] = _LETTER[raw]
        edges = np.flatnonzero(letter[1:] != letter[:-1])
        start, end = edges[::2], edges[1::2]
        if not len(start):
            return start
        total, down = self._sums(_LOWER[raw])
        found = np.isin(mix((total[end] - total[start]) * down[start]), self.word_hashes)
        for n, stems in self.stem_hashes.items():
            long = np.flatnonzero(end - start >= n)
            at = start[long]
            found[long] |= np.isin(mix((total[at + n] - total[at]) * down[at]), stems)
        return start[found]


class Scorer:
    """Clause label counts of texts, and their scores under fitted weights."""

    def __init__(self, words: set[bytes], stems: set[bytes], mild: frozenset[bytes] = frozenset()) -> None:
        threats = {w.encode() for w in THREATS}
        self.insults = Lexicon(words - threats, stems)
        self.mild = mild
        self.either = Lexicon(words | mild | threats, stems)
        self.closed = {w.encode(): kind for kind, group in
                       ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS)) for w in group}

    def classes(self, text: bytes) -> list[int]:
        out = []
        for token in _TOKEN.findall(text.lower()):
            if token in b".!?;:\n":
                out.append(END)
            elif token == b'"':
                out.append(QUOTE)
            else:
                out.append(self.closed.get(token) or (INSULT if self.insults.holds(token) else MILD if token in self.mild else OTHER))
        return [*out, END]

    def counts(self, text: bytes | None) -> np.ndarray:
        """How many clauses carry each label."""
        found = np.zeros(len(LABELS))
        if not text or not len(self.either.hits(text)):
            return found
        for label in run(GRAMMAR, self.classes(text)):
            if label >= 0:
                found[label] += 1
        return found

    def labels(self, texts: list[bytes | None]) -> np.ndarray:
        return np.array([self.counts(t) for t in texts]).reshape(len(texts), len(LABELS))


def design(counts: np.ndarray) -> np.ndarray:
    """What the weights apply to: per kind the clauses of it, and those of them addressed."""
    out = counts.astype(float)
    out[:, 0::2] += out[:, 1::2]
    return np.log2(1 + out)


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression, ridge towards the prior weights; the first weight is the bias."""
    x = np.hstack([np.ones((len(x), 1)), x])
    prior = np.array([-3.0, *PRIOR])
    penalty = np.full(len(prior), ridge)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _terms(text: bytes) -> set[tuple[bool, bytes]]:
    words = set(_WORD.findall(text.lower()))
    return {(False, w) for w in words if len(w) > 2} | {(True, w[:n]) for w in words for n in STEM_BYTES if len(w) >= n}


def _families(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        keys = [hashlib.blake2b(shingle_set(text, 3).tobytes(), digest_size=16).digest() for text in binaries(batch.column(1))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["doc", "text", "label", "family"])


def _counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 400):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(binaries(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            seen[int(label)].update(_terms(text or b""))
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in terms], pa.bool_()), pa.array([t for _, t in terms], pa.binary()),
             pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([seen[0][t] for t in terms], pa.int64())],
            names=["stem", "term", "n1", "n0"])


def training_rows(docs: DataFrame, labels: DataFrame, target_col: str, held_out: Column, limit: int) -> DataFrame:
    """``(doc, text, label)`` of at most ``limit`` labelled rows outside the held-out fold.

    Rows that repeat an id count once, with their largest label; rows with a null id, label
    or text are left out.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc"), F.col(target_col).cast("int").alias("label")) \
        .filter("doc is not null and label in (0, 1)").filter(~held_out) \
        .groupBy("doc").agg(F.max("label").alias("label")) \
        .orderBy(F.xxhash64("doc"), "doc").limit(limit)
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")) \
        .filter("text is not null").join(chosen, "doc").select("doc", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, limit: int = TRAIN_ROWS) -> tuple[Scorer, np.ndarray]:
    """The lexicon and the weights, from the labelled rows outside the held-out fold.

    ``held_out`` is a condition on the column ``doc``.  With no row of one of the classes the
    lexicon is empty and the weights are the grammar's own.
    """
    rows = training_rows(docs, labels, "toxic", held_out, limit)
    # Rows of one label with equal sets of shingles count once.
    distinct = rows.mapInArrow(tidy("toxicity", _families), "doc long, text string, label int, family binary") \
        .groupBy("family", "label").agg(F.min(F.struct("doc", "text", "label")).alias("least")).select("least.*")
    distinct = cut(distinct.select("doc", "text", "label"), "training")
    total = {r["label"]: r["count"] for r in distinct.groupBy("label").count().collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    words: set[bytes] = set()
    stems: set[bytes] = set()
    mild: set[bytes] = set()
    if n1 and n0:
        terms = distinct.mapInArrow(tidy("toxicity", _counted), "stem boolean, term binary, n1 long, n0 long") \
            .groupBy("stem", "term").agg(F.sum("n1").alias("a"), F.sum("n0").alias("b"))
        rate = n1 / (n1 + n0)
        log = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(F.lit(0.0))
        seen = F.col("a") + F.col("b")
        ratio = 2 * (log(F.col("a"), seen * rate) + log(F.col("b"), seen * (1 - rate)))
        odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
        # Terms of a single row cannot pass; the others are the candidates of the test.
        terms = cut(terms.filter("a + b > 1").withColumns({"ratio": ratio, "odds": odds}), "terms")
        # About one term in all would pass by chance.
        floor = 2 * np.log(terms.count() + 1)
        # A stem must stand for several words that clean rows lack, and be as clean as a word.
        prefix = F.explode(F.array(*(F.when(F.length("term") >= n, F.substring("term", 1, n)) for n in STEM_BYTES)))
        variety = terms.filter("not stem and a > 0 and b = 0").select(prefix.alias("term")) \
            .filter("term is not null").groupBy("term").agg(F.count("*").alias("words"))
        chosen = terms.join(variety, "term", "left") \
            .filter((F.col("ratio") > float(floor)) & (F.col("odds") > 3.5)) \
            .withColumn("pure", PURITY * F.col("b") <= F.col("a")) \
            .filter(~F.col("stem") | (F.col("words") >= STEM_WORDS) & F.col("pure")) \
            .orderBy(F.desc("ratio"), "term", "stem").limit(LEXICON_TERMS)
        for r in chosen.select("stem", "term", "pure").collect():
            (stems if r["stem"] else words if r["pure"] else mild).add(bytes(r["term"]))
        stems = {s for s in stems if not any(s[:n] in stems for n in STEM_BYTES if n < len(s))}
    scorer = Scorer(words, stems, frozenset(mild))

    def vectors(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(design(scorer.labels(binaries(batch.column(1))))), pa.list_(pa.float64())), batch.column(2)],
                names=["x", "label"])

    found = distinct.mapInArrow(tidy("toxicity", vectors), "x array<double>, label int").groupBy("x", "label").count().collect()
    x = np.array([r["x"] for r in found for _ in range(r["count"])]).reshape(-1, len(LABELS))
    y = np.array([r["label"] for r in found for _ in range(r["count"])], dtype=float)
    weights = fit_weights(x, y) if len(set(y)) == 2 else np.array([-3.0, *PRIOR])
    return scorer, weights


def score(docs: DataFrame, model: tuple[Scorer, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, score, labels, *carry)`` per row: the score and how many clauses carry each label.

    The whole text is read.  A null or empty text has no clause and gets the score of a
    clean text.  Null ids, repeated rows, an empty table and further columns are fine:
    each row is scored by its text alone.
    """
    scorer, weights = model

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            counts = scorer.labels(binaries(batch.column(1)))
            z = weights[0] + design(counts) @ weights[1:]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500)))),
                 pa.array(list(counts.astype(np.int64)), pa.list_(pa.int64())), *batch.columns[2:]],
                names=["id", "score", "labels", *batch.schema.names[2:]])

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       *(F.col(c) for c in carry))
    schema = "id long, score double, labels array<long>" + "".join(
        f", `{c}` {base.schema[c].dataType.simpleString()}" for c in carry)
    return base.mapInArrow(tidy("toxicity", scored), schema)


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    found = F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder
    return F.coalesce(found, F.lit(False))

