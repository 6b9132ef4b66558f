"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A text is cut into the matches of the tokenizer's pattern; each match is encoded by itself.  A
match that is a token as a whole is that token.  Otherwise every byte position starts as a token
of its own, and the leaf of a live position holds the rank of the pair that its token forms with
the next live one (none: a rank above all).  Inner nodes hold the least rank below them, so a
walk from the root that goes left on equal ranks ends at the leftmost pair of least rank.  A merge joins that pair and makes three point updates on live neighbours: the pair before
the joined token, the pair after it, and the position that died.  A match of n bytes takes
O(n log n), whatever it repeats.

Matches are short as a rule and recur, so a task encodes the distinct ones of a block of texts,
short ones with their trees side by side in arrays (one merge a round in each), and remembers up to ``MEMO`` of at most ``MEMO_CHARS`` characters; a full memo is emptied, which
changes no result; a worker keeps it until it turns to another operator.  A task holds the vocabulary, the memo, a batch of
texts with its ids (about ``BATCH_UNITS``, or one text), the matches of a block of a text, and
about 24 bytes per byte of the longest match.

Defined cases: a null text encodes like an empty one, to no ids; null ids, repeated rows, an
empty table and further columns are fine; texts of any length are encoded whole, and a match of
any length (a text without a break is one) whole too.  Equal ranks do not occur within a
vocabulary; among equal pairs the leftmost is merged first.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import keeps, tidy

VOCABULARY = "byte_bpe_50k.tiktoken"
MEMO = 250_000
MEMO_CHARS = 48
BLOCK = 2_000_000           # characters whose matches are held at once
SMALL = 4_096               # bytes of a match up to which plain lists serve
SIDE_BY_SIDE = 64           # bytes of a match up to which trees stand side by side
TREES = 8_192               # of them at once,
FEW = 24                    # and below so many one by one
BATCH_UNITS = 4_000_000
BATCH_ROWS = 2_000
NONE = 2 ** 31 - 1          # above every rank


def load(path: str | None = None) -> bytes:
    """The rank file's bytes (shipped with the tasks; a vocabulary's size bounds them)."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return f.read()


def ranks_of(data: bytes) -> dict[bytes, int]:
    """Token bytes -> id of a rank file: a line per token, base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


class PairRanks:
    """Segment tree over positions; a leaf holds the rank of the pair that starts there."""

    def __init__(self, leaves: list[int]) -> None:
        size = self.size = 1 << max(0, (len(leaves) - 1).bit_length())
        tree = [NONE] * size + leaves + [NONE] * (size - len(leaves))
        if size > SMALL:                     # four bytes a node instead of references
            tree = array("i", tree)
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left <= right else right
        self.tree = tree

    def update(self, at: int, rank: int) -> None:
        tree = self.tree
        at += self.size
        tree[at] = rank
        while at > 1:
            other = tree[at ^ 1]
            at >>= 1
            if other < rank:
                rank = other
            if tree[at] == rank:
                break
            tree[at] = rank

    def leftmost_least(self) -> int:
        """The position of the leftmost least rank; -1: no pair is left."""
        tree, size, node = self.tree, self.size, 1
        least = tree[1]
        if least == NONE:
            return -1
        while node < size:
            node *= 2
            if tree[node] != least:
                node += 1
        return node - size


def merge(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """The ids of one match by the merge rule."""
    n, rank_of = len(piece), ranks.get
    # The live token at a position ends where the next one begins.
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    if n > SMALL:
        end, before = array("i", end), array("i", before)
    pairs = PairRanks([rank_of(piece[i:i + 2], NONE) for i in range(n - 1)] + [NONE])
    update, leftmost_least = pairs.update, pairs.leftmost_least
    while (at := leftmost_least()) >= 0:
        dead = end[at]
        stop = end[at] = end[dead]
        update(dead, NONE)
        if stop < n:
            before[stop] = at
            update(at, rank_of(piece[at:end[stop]], NONE))
        else:
            update(at, NONE)
        first = before[at]
        if first >= 0:
            update(first, rank_of(piece[first:stop], NONE))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


class Pairs:
    """Ranks of pairs of token ids, for arrays: a pair's rank is the id of the joint token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.base = max(ranks.values()) + 1
        found = [(ranks[token[:i]] * self.base + ranks[token[i:]], rank) for token, rank in ranks.items()
                 for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        keys, joint = np.array(sorted(found), dtype=np.int64).reshape(-1, 2).T
        self.keys, self.joint = np.append(keys, np.iinfo(np.int64).max), np.append(joint, NONE).astype(np.int32)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``NONE`` where the two form no token or one of them is below zero."""
        key = np.where((a < 0) | (b < 0), -1, a.astype(np.int64) * self.base + b)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.joint[at], NONE)


def merge_many(pairs: Pairs, byte_ids: np.ndarray, pieces: list[bytes]) -> list[bytes]:
    """The packed ids of matches of two bytes and more, by the rule of ``merge``.

    Their segment trees stand side by side, all with the leaves of the longest; a round makes
    one merge with its three point updates in every tree that still has a pair.
    """
    lengths = np.array([len(p) for p in pieces])
    m, size = len(pieces), 1 << int(lengths.max() - 1).bit_length()
    # Positions up to the size; the one after the last byte and one before the first hold no token.
    token = np.full((m, size + 2), -1, dtype=np.int32)
    token[:, :size][np.arange(size) < lengths[:, None]] = byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.broadcast_to(np.arange(1, size + 3, dtype=np.int32), (m, size + 2)).copy()
    before = after - 2
    tree = np.full((m, 2 * size), NONE, dtype=np.int32)
    tree[:, size:] = pairs.ranks(token[:, :size], token[:, 1:size + 1])
    for level in range(size.bit_length() - 2, -1, -1):
        first = 1 << level
        tree[:, first:2 * first] = np.minimum(tree[:, 2 * first:4 * first:2], tree[:, 2 * first + 1:4 * first:2])
    rows = np.flatnonzero(tree[:, 1] != NONE)
    while len(rows):
        least, node = tree[rows, 1], np.ones(len(rows), dtype=np.int64)
        for _ in range(size.bit_length() - 1):
            node *= 2
            node += tree[rows, node] != least
        at = node - size
        dead = after[rows, at]
        stop = after[rows, dead]
        first = before[rows, at]
        token[rows, at], token[rows, dead] = least, -1
        after[rows, at], before[rows, stop] = stop, at
        # -1 (nothing before) reads the last column, which holds no token; its update repeats one.
        tree[rows, size + dead] = NONE
        tree[rows, size + at] = pairs.ranks(least, token[rows, stop])
        tree[rows, size + np.where(first < 0, dead, first)] = pairs.ranks(token[rows, first], least)
        for changed in _paths(size, dead, at, np.where(first < 0, dead, first)):
            tree[rows, changed] = np.minimum(tree[rows, 2 * changed], tree[rows, 2 * changed + 1])
        rows = rows[tree[rows, 1] != NONE]
    live = token[:, :size] >= 0
    packed, ends = token[:, :size][live].tobytes(), (4 * live.sum(axis=1).cumsum()).tolist()
    return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _paths(size: int, *leaves: np.ndarray) -> Iterator[np.ndarray]:
    """The inner nodes above leaves, level by level."""
    nodes = [(size + leaf) >> 1 for leaf in leaves]
    while nodes[0][0] > 0:
        yield from nodes
        nodes = [n >> 1 for n in nodes]


class Vocabulary:
    """The tables of a rank file: bounded by the file, so a worker keeps the last one."""

    def __init__(self, data: bytes) -> None:
        self.ranks = ranks_of(data)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.pairs = Pairs(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    @staticmethod
    @lru_cache(maxsize=1)
    def of(data: bytes) -> Vocabulary:
        return Vocabulary(data)


class Tokenizer:
    """A vocabulary with its pattern; ids of matches are remembered as 32-bit integers."""

    def __init__(self, data: bytes, pattern: str = public_tokenizers.PATTERN) -> None:
        vocabulary = Vocabulary.of(data)
        self.ranks, self.pairs, self.byte_ids = vocabulary.ranks, vocabulary.pairs, vocabulary.byte_ids
        self.pattern = regex.compile(pattern)
        # No match of the public pattern goes from a character on to a white space after it, and
        # the pattern looks at nothing before a match: there a text can be cut.
        self.cut = regex.compile(r"(?<=\S)(?=\s)") if pattern == public_tokenizers.PATTERN else None
        self.memo: dict[str, bytes] = {}

    def _learn(self, matches: set[str]) -> None:
        """Put the ids of matches into the memo: whole tokens, else merged, short ones together."""
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for match in matches:
            piece = match.encode("utf-8")
            whole = self.ranks.get(piece)
            if whole is not None:
                self.memo[match] = whole.to_bytes(4, sys.byteorder)
            elif len(piece) <= SIDE_BY_SIDE:
                classes.setdefault((len(piece) - 1).bit_length(), []).append((match, piece))
            else:
                self.memo[match] = array("i", merge(self.ranks, piece)).tobytes()
        for members in classes.values():
            for start in range(0, len(members), TREES):
                part = members[start:start + TREES]
                if len(part) < FEW:
                    found = [array("i", merge(self.ranks, piece)).tobytes() for _, piece in part]
                else:
                    found = merge_many(self.pairs, self.byte_ids, [piece for _, piece in part])
                self.memo.update(zip((match for match, _ in part), found, strict=True))

    def _blocks(self, text: str) -> Iterator[str]:
        start = 0
        while self.cut is not None and len(text) - start > BLOCK:
            found = self.cut.search(text, start + BLOCK)
            if found is None:
                break
            yield text[start:found.start()]
            start = found.start()
        yield text[start:] if start else text

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as native 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for block in self._blocks(text or ""):
                held.append((i, self.pattern.findall(block)))
                size += len(block)
                if size >= BLOCK:
                    self._emit(held, out)
                    held, size = [], 0
        self._emit(held, out)
        return [b"".join(parts) for parts in out]

    def _emit(self, held: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        memo = self.memo
        matches = set().union(*(m for _, m in held))
        new = matches.difference(memo)
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = matches
        self._learn(new)
        for i, found in held:
            out[i].append(b"".join(map(memo.__getitem__, found)))
        for match in new:
            if len(match) > MEMO_CHARS:
                del memo[match]


    @staticmethod
    @lru_cache(maxsize=1)
    def of(data: bytes) -> Tokenizer:
        return Tokenizer(data)


def _forget() -> None:
    Tokenizer.of.cache_clear()
    Vocabulary.of.cache_clear()


keeps("byte_merges", _forget)


class Detokenizer:
    """Bytes of ids."""

    def __init__(self, data: bytes) -> None:
        tokens = {rank: token for token, rank in ranks_of(data).items()}
        self.tokens: list[bytes | None] = [tokens.get(i) for i in range(max(tokens) + 1)]

    def decode(self, ids: list[int]) -> bytes:
        if ids and min(ids) < 0:
            raise ValueError("an id below zero")
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


def _pieces(rows: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most ``BATCH_ROWS`` rows and about ``size`` units of a column."""
    for batch in rows:
        values = batch.column(column)
        units = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        start = held = 0
        for i, n in enumerate(units.fill_null(0).to_pylist()):
            if i > start and (i - start >= BATCH_ROWS or held + n > size):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start, batch.num_rows - start)


def encode(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, ids array<int>, *carry)`` per row of whole texts."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *(F.col(c) for c in carry))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.of(vocabulary)
        for batch in _pieces(rows, 1, BATCH_UNITS):
            found = tokenizer.encode(batch.column(1).to_pylist())
            offsets = np.cumsum([0, *(len(ids) // 4 for ids in found)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32))),
                 *batch.columns[2:]], names=["id", "ids", *batch.schema.names[2:]])

    return base.mapInArrow(tidy("byte_merges", run), "id long, ids array<int>" + _types(base, carry))


def decode(encoded: DataFrame, vocabulary: bytes, id_col: str = "id", ids_col: str = "ids",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, bytes binary, *carry)`` per row of ids; null ids give null.

    Ids outside the vocabulary or null ones within a list fail the job.
    """
    base = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"), *(F.col(c) for c in carry))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Detokenizer(vocabulary)
        for batch in _pieces(rows, 1, BATCH_UNITS):
            ids = batch.column(1)
            values, ends = ids.flatten().to_pylist(), pc.list_value_length(ids).fill_null(0).to_numpy().cumsum().tolist()
            found = [decoder.decode(values[a:b]) if known else None
                     for a, b, known in zip([0, *ends[:-1]], ends, ids.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), *batch.columns[2:]],
                                             names=["id", "bytes", *batch.schema.names[2:]])

    return base.mapInArrow(tidy("byte_merges", run), "id long, bytes binary" + _types(base, carry))


def _types(df: DataFrame, carry: tuple[str, ...]) -> str:
    return "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in carry)
