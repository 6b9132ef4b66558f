import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from quorum.llm import byte_merges as bm
from tests.llm.helpers import docs

DATA = bm.load()
RANKS = bm.ranks_of(DATA)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = ["", " ", "  ", "\n\n\n a", "hello world", "I'm don't we'll", "<|endoftext|>", "a" * 3000, "ab" * 900, " " * 999,
         "日本語テキスト漢字" * 40, "🙂🙂 ok 🙂", "é" * 60, "​ x", "\x00\x01", "1234567890" * 50, "!?" * 200, "\t\tx = 3.14e-10\r\n"]


def ids_of(tokenizer, text):
    return np.frombuffer(tokenizer.encode([text])[0], np.int32).tolist()


def plain(piece: bytes) -> list[int]:
    """The merge rule over a list of parts."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(RANKS.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        pairs = [p for p in pairs if p[0] is not None]
        if not pairs:
            return [RANKS[p] for p in parts]
        _, at = min(pairs)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def test_merge_equals_the_plain_rule():
    rng = random.Random(5)
    for _ in range(400):
        piece = bytes(rng.choice(b"abest in\xc3\xa9\xf0th") for _ in range(rng.randrange(1, 60)))
        assert bm.merge(RANKS, piece) == plain(piece)


def test_side_by_side_equals_one_by_one():
    rng = random.Random(11)
    vocabulary = bm.Vocabulary(DATA)
    for longest in (2, 3, 4, 9, 33, 64):
        pieces = [bytes(rng.choice(b"abest in\xc3\xa9\xf0th") for _ in range(rng.randrange(2, longest + 1))) for _ in range(300)]
        pieces += [b"a" * longest, b"\x00" * longest]
        got = bm.merge_many(vocabulary.pairs, vocabulary.byte_ids, pieces)
        assert [np.frombuffer(g, np.int32).tolist() for g in got] == [plain(p) for p in pieces]


def test_equals_the_library_on_random_and_given_texts(spark):
    tokenizer, decoder = bm.Tokenizer(DATA), bm.Detokenizer(DATA)
    rng = random.Random(6)
    texts = TEXTS + ["".join(rng.choice("aeiou nrst\n  éßñ,.'漢🙂9") for _ in range(rng.randrange(500))) for _ in range(100)]
    texts += [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text, packed in zip(texts, tokenizer.encode(texts), strict=True):
        ids = np.frombuffer(packed, np.int32).tolist()
        assert ids == LIBRARY.encode_ordinary(text), text[:80]
        assert decoder.decode(ids) == text.encode()


def test_other_vocabulary():
    data = bm.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    lib = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bm.ranks_of(data), special_tokens={})
    tokenizer = bm.Tokenizer(data)
    for text in TEXTS:
        assert ids_of(tokenizer, text) == lib.encode_ordinary(text)


def test_segment_tree_keeps_the_leftmost_least():
    rng = random.Random(7)
    for n in (1, 2, 3, 5, 8, 9, 33, 37):
        leaves = [rng.randrange(5) for _ in range(n)]
        tree = bm.PairRanks(leaves)
        for _ in range(60):
            at, rank = rng.randrange(n), rng.choice([0, 1, 2, 3, bm.NONE])
            leaves[at] = rank
            tree.update(at, rank)
            assert tree.leftmost_least() == (-1 if min(leaves) == bm.NONE else leaves.index(min(leaves)))


def test_long_match_and_small_memo(monkeypatch):
    tokenizer = bm.Tokenizer(DATA)
    long = "x" * 60_000 + "qz" * 20_000
    assert ids_of(tokenizer, long) == LIBRARY.encode_ordinary(long)
    monkeypatch.setattr(bm, "MEMO", 3)
    monkeypatch.setattr(bm, "FEW", 0)
    text = " ".join(f"word{i % 7} naïvety{i}" for i in range(200))
    assert ids_of(bm.Tokenizer(DATA), text) == LIBRARY.encode_ordinary(text)


def test_blocks_of_a_text_give_the_matches_of_the_whole(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(bm, "BLOCK", 7)
    for _ in range(300):
        text = "".join(rng.choice(" \n\t\u00a0ab1.'s漢") for _ in range(rng.randrange(80)))
        assert ids_of(bm.Tokenizer(DATA), text) == LIBRARY.encode_ordinary(text), repr(text)


def test_digests_nulls_repeats_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(bm, "BATCH_UNITS", 100)
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "x y"), (1, "hello world"), (4, "long " * 5000), (5, "日本 🙂")]
    table = docs(spark, rows).selectExpr("*", "'a' as ids", "1 as id", "'b' as bytes")
    encoded = bm.encode(table, DATA)
    found = bm.decode(encoded, DATA).collect()
    assert sorted(((r.id is None, r.id, bytes(r.bytes)) for r in found), key=str) == \
        sorted(((i is None, i, (t or "").encode()) for i, t in rows), key=str)
    got = {(r.id, tuple(r.ids)) for r in encoded.collect()}
    assert got == {(i, tuple(LIBRARY.encode_ordinary(t or ""))) for i, t in rows}
    assert bm.encode(docs(spark, []), DATA).count() == 0
    assert bm.decode(spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>"), DATA).collect()[0].bytes is None


def test_query_equals_the_library(spark):
    from quorum.llm.queries import QUERIES
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in QUERIES["op13_byte_merges"](spark, "/root/testdata/sf0.001").collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError, match="single bytes"):
        bm.Tokenizer(b"YQ== 0\n")
    assert regex.compile(public_tokenizers.PATTERN).findall("a b") == ["a", " b"]
