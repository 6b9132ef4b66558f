"""SentencePiece encoding and decoding by a streaming Viterbi search.

A model file gives pieces with scores and its kind.  The search walks a text once and keeps
the best path to each of the last ``longest piece`` positions; whenever the paths to all of
them pass one boundary, the ids before it are committed and forgotten.

* unigram models: the best path has the largest sum of scores, ties to the longer piece;
* BPE models: a piece sequence is the model's own encoding exactly if every two neighbours
  encode, as one string, to just these two.  So the search keeps, per position, the one last
  piece that fits the path it extends: a Viterbi search whose transitions weigh nothing or
  are forbidden.  Which pairs fit is decided by the model's merge rule and remembered.  An
  automaton over the pieces gives those that end at a position, so a position asks only for
  the pairs up to the one that fits.

No piece spans a change from other characters to the space mark (a property checked on the
model; without it a text is one stretch).  All paths meet there, so these stretches are
searched one by one, each once per block of texts, and a bounded memo keeps their ids from block to
block until the worker turns to another operator.  For BPE models with byte pieces a stretch
also ends where characters change that no piece holds together (words and punctuation, say).
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import batches, keeps, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MEMO = 400_000
MEMO_CHARS = 32
PAIRS = 250_000
BATCH_ROWS = 512
BLOCK = 1_000_000         # characters whose stretches are held at once, or one text
CLASSES = 8               # of characters that end a stretch where they change
SPACE = "▁"
# Piece kinds and model kinds of the model file format.
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialized message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            value = varint()
        else:
            size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class Model:
    """Pieces, scores and settings of a serialized model."""

    def __init__(self, data: bytes) -> None:
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                fields = dict(_fields(value))
                pieces.append((fields.get(1, b"").decode(), struct.unpack("<f", fields.get(2, b"\0" * 4))[0],
                               fields.get(3, _NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.kind = trainer.get(3, _UNIGRAM)
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models are supported")
        if normalizer.get(2) or not normalizer.get(5, 1) or any(k == _USER for _, _, k in pieces):
            raise ValueError("models with a character map, plain spaces or user-defined pieces are not supported")
        self.prefix = bool(normalizer.get(3, 1))
        self.squeeze = bool(normalizer.get(4, 1))
        self.pieces = [p for p, _, _ in pieces]
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == _NORMAL}
        self.scores = [s for _, s, _ in pieces]
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == _UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.longest = max(map(len, self.ids))
        self.least = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        self.stretches = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        # Bytes of each id in a decoded text; None: it stands for nothing.
        unknown_surface = trainer.get(44, " ⁇ ".encode())
        self.surface = [p.replace(SPACE, " ").encode() if kind == _NORMAL else unknown_surface if kind == _UNKNOWN
                        else bytes([int(p[3:5], 16)]) if kind == _BYTE else b"" for p, _, kind in pieces]
        # Pieces by their characters: a node is the id of the piece that ends there (None: no
        # piece) and its children.
        self.trie: list = [None, {}]
        for piece, id_ in self.ids.items():
            node = self.trie
            for c in piece:
                node = node[1].setdefault(c, [None, {}])
            node[0] = id_
        self.singles = {p for p in self.ids if len(p) == 1}
        self.known: dict[int, bool] = {}
        self.stretch = re.compile(self._stretch())
        self.start = None
        if self.kind == _BPE:
            self.start, self.trie = self._automaton(), None

    def _stretch(self) -> str:
        """A stretch begins with its space marks and ends before the next one, or before a
        character of another class: no piece holds two neighbours of different classes."""
        if not (self.kind == _BPE and self.bytes):
            return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        group: dict[str, str] = {}

        def root(c: str) -> str:
            while group.setdefault(c, c) != c:
                group[c] = c = group[group[c]]
            return c

        for piece in self.ids:
            bare = piece.lstrip(SPACE)
            for a, b in zip(bare, bare[1:]):
                group[root(a)] = root(b)
        members: dict[str, list[str]] = {}
        for c in group:
            members.setdefault(root(c), []).append(re.escape(c))
        classes = ["".join(sorted(m)) for m in sorted(members.values(), key=len, reverse=True)[:CLASSES]]
        return f"{SPACE}*(?:{''.join(f'[{c}]+|' for c in classes)}[^{SPACE}{''.join(classes)}]+)|{SPACE}+"

    def _automaton(self) -> list:
        """States by the longest suffix read that begins a piece: the pieces that end there
        (longest first, with their lengths), the states after known characters, the state of
        the longest proper suffix."""
        start: list = [(), {}, None]
        row = [(self.trie, start, 0)]
        while row:
            below = []
            for (_, children), state, depth in row:
                for c, child in children.items():
                    shorter = self.step(state[2], c) if state[2] else start
                    ends = shorter[0] if child[0] is None else ((depth + 1, child[0]), *shorter[0])
                    state[1][c] = after = [ends, {}, shorter]
                    below.append((child, after, depth + 1))
            row = below
        return start

    @staticmethod
    def step(state: list, c: str) -> list:
        """The state after a character that ``state`` may not have."""
        while c not in state[1] and state[2]:
            state = state[2]
        return state[1].get(c, state)

    def normalized(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = text.replace(" ", SPACE)
        return SPACE + text if self.prefix else text

    def merged(self, text: str) -> list[str]:
        """The merge rule: join the neighbours of the best scored joint piece, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, where = self.scores[found], i
            if where < 0:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def fits(self, before: int, piece: int) -> bool:
        """Whether a piece may follow another (-1: a character without a piece, or none)."""
        if len(self.known) >= PAIRS:
            self.known.clear()
        pair = ([self.pieces[before]] if before >= 0 else []) + [self.pieces[piece]]
        found = self.known[before * len(self.pieces) + piece] = self.merged("".join(pair)) == pair
        return found

    @staticmethod
    @lru_cache(maxsize=4)
    def of(data: bytes) -> Model:
        return Model(data)


class Stream:
    """Feeds characters to the search and gives ids as soon as they are certain.

    For BPE models every position is settled when it is read (``_settle``); for unigram models
    it waits for the pieces that start before it (``_extend``).

    Position i of ``text`` (what follows the last commit) has the start of its last piece in
    ``back``, that piece in ``last`` and the path's score in ``best``; None: no path yet.
    Positions below ``done`` have been extended by every piece that starts there.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        self.most = 0           # longest text held between two commits
        self._reset(-1)

    def _reset(self, before: int) -> None:
        self.text, self.done, self.state = "", 0, self.model.start
        self.back: list[int | None] = [0]
        self.last, self.best = [before], [0.0]

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        longest = self.model.longest
        if len(self.text) + len(text) <= 2 * longest:
            self._take(text)
            return out
        for start in range(0, len(text), longest):
            self._take(text[start:start + longest])
            self._search(len(self.text) - longest + 1)
            out += self._commit()
        return out

    def close(self) -> list[int]:
        self._search(len(self.text))
        out = self._path(len(self.text))
        self._reset(-1)
        return out

    def _take(self, more: str) -> None:
        self.text += more
        self.most = max(self.most, len(self.text))
        if self.state is None:
            self.back += [None] * len(more)
            self.last += [-1] * len(more)
            self.best += [0.0] * len(more)

    def _search(self, stop: int) -> None:
        if self.state is None:
            self._extend(stop)
        else:
            self.state = self._settle(self.text, self.back, self.last, self.state)
            self.best += [0.0] * (len(self.back) - len(self.best))
        self.done = max(self.done, stop)

    def _settle(self, text: str, back: list[int | None], last: list[int], state: list) -> list:
        """The last piece of every position beyond those in ``back``; the state after the text."""
        model = self.model
        known, step, size = model.known, model.step, len(model.pieces)
        end = len(back) - 1
        for c in text[end:] if end else text:
            end += 1
            state = state[1].get(c) or step(state, c)
            # Only one last piece fits, so the first that does is it.
            for length, id_ in state[0]:
                start = end - length
                before = last[start]
                fits = known.get(before * size + id_)
                if fits is None:
                    fits = model.fits(before, id_)
                if fits and back[start] is not None:
                    back.append(start)
                    last.append(id_)
                    break
            else:
                back.append(None if c in model.singles or back[end - 1] is None else end - 1)
                last.append(-1)
        return state

    def whole(self, text: str) -> list[int]:
        """The ids of a whole text, when nothing has been fed."""
        if self.state is None or len(text) > 2 * self.model.longest:
            return self.feed(text) + self.close()
        back, last, out = [0], [-1], []
        self._settle(text, back, last, self.model.start)
        end = len(text)
        while end > 0:
            if last[end] < 0:
                return self.feed(text) + self.close()
            out.append(last[end])
            end = back[end]
        out.reverse()
        return out

    def _extend(self, stop: int) -> None:
        model, text, back, last, best = self.model, self.text, self.back, self.last, self.best
        roots, singles, scores, end_of_text = model.trie[1], model.singles, model.scores, len(text)
        for start in range(self.done, stop):
            if back[start] is None:
                continue
            if text[start] not in singles and (back[start + 1] is None or best[start] + model.least > best[start + 1]):
                back[start + 1], last[start + 1], best[start + 1] = start, -1, best[start] + model.least
            below, end = roots, start
            while end < end_of_text:
                node = below.get(text[end])
                if node is None:
                    break
                end += 1
                id_, below = node
                if id_ is not None and (back[end] is None or best[start] + scores[id_] > best[end]):
                    back[end], last[end], best[end] = start, id_, best[start] + scores[id_]

    def _commit(self) -> list[int]:
        """Ids up to the last boundary that the paths to all open positions share."""
        open_ = {i for i in range(self.done, min(self.done + self.model.longest, len(self.text) + 1))
                 if self.back[i] is not None}
        while len(open_) > 1:
            furthest = max(open_)
            open_.remove(furthest)
            open_.add(self.back[furthest])
        at = open_.pop()
        if not at:
            return []
        out, base = self._path(at), self.best[at]
        self.text, self.done = self.text[at:], self.done - at
        self.last = self.last[at:]
        self.best = [b - base for b in self.best[at:]]
        # Positions whose last piece starts before the boundary are no longer extended.
        self.back = [0, *(None if b is None else b - at for b in self.back[at + 1:])]
        return out

    def _path(self, end: int) -> list[int]:
        """Ids along the path to ``end``; characters without a piece become bytes."""
        out: list[int] = []
        unknown = False
        while end > 0:
            id_, start = self.last[end], self.back[end]
            if id_ >= 0:
                out.append(id_)
            elif self.model.bytes:
                out += [self.model.bytes[b] for b in reversed(self.text[start:end].encode())]
            elif not unknown:
                out.append(self.model.unknown)
            unknown = id_ < 0
            end = start
        return out[::-1]


class Encoder:
    """Encodes texts; remembers the ids of short stretches, half of them at a time those met
    since the last change of halves, so that rare ones push no frequent one out."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.stream = Stream(model)

    def _search(self, stretch: str) -> bytes:
        return array("i", self.stream.whole(stretch)).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as native 32-bit integers; a stretch is searched once per call."""
        normal = [self.model.normalized(t or "") for t in texts]
        if not self.model.stretches:
            return [self._search(t) if t else b"" for t in normal]
        out, held, size = [], [], 0
        for text in normal:
            held.append(self.model.stretch.findall(text))
            size += len(text)
            if size >= BLOCK:
                out += self._joined(held)
                held, size = [], 0
        return out + self._joined(held)

    def _joined(self, held: list[list[str]]) -> list[bytes]:
        memo = self.memo
        stretches = set().union(*held)
        new = stretches.difference(memo)
        if len(memo) + len(new) > MEMO // 2:
            self.older, self.memo = memo, {s: memo[s] for s in stretches.difference(new)}
            memo = self.memo
        older = self.older
        for stretch in new:
            memo[stretch] = older.get(stretch) or self._search(stretch)
        out = [b"".join(map(memo.__getitem__, found)) for found in held]
        for stretch in new:
            if len(stretch) > MEMO_CHARS:
                del memo[stretch]
        return out

    @staticmethod
    @lru_cache(maxsize=4)
    def of(data: bytes) -> Encoder:
        return Encoder(Model.of(data))


def _forget() -> None:
    Encoder.of.cache_clear()
    Model.of.cache_clear()


keeps("pieces", _forget)


def decode_ids(model: Model, ids: list[int]) -> str:
    """The text of ids: pieces with spaces for space marks, bytes joined as UTF-8."""
    surface = model.surface
    text = b"".join([surface[i] for i in ids])
    if model.prefix and text.startswith(b" "):
        text = text[1:]
    return text.decode("utf-8", errors="replace")


def load(path: str = MODEL) -> bytes:
    """The model file's bytes (it is shipped with the tasks; a vocabulary's size bounds it)."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, ids array<int>, round_trip, *carry)`` per row.

    ``round_trip`` tells whether decoding gives the text back; with a model that keeps
    spaces and has bytes for unknown characters only a text that holds the space mark
    itself does not.  A null text encodes like an empty one, to no ids.  Null ids, repeated
    rows, an empty table and further columns are fine.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       *(F.col(c) for c in carry))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(model)
        for batch in batches(rows, BATCH_ROWS):
            texts = batch.column(1).to_pylist()
            found = encoder.encode(texts)
            offsets = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])])
            values = np.frombuffer(b"".join(found), dtype=np.int32)
            same = [decode_ids(encoder.model, values[a:b].tolist()) == (t or "")
                    for a, b, t in zip(offsets[:-1], offsets[1:], texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                 pa.array(same, pa.bool_()), *batch.columns[2:]],
                names=["id", "ids", "round_trip", *batch.schema.names[2:]])

    schema = "id long, ids array<int>, round_trip boolean" + "".join(
        f", `{c}` {base.schema[c].dataType.simpleString()}" for c in carry)
    return base.mapInArrow(tidy("pieces", run), schema)


def decode(encoded: DataFrame, model: bytes, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` per row of ids; null ids give a null text."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Model.of(model)
        for batch in batches(rows, BATCH_ROWS):
            texts = [None if ids is None else decode_ids(decoder, ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids")) \
        .mapInArrow(tidy("pieces", run), "id long, text string")
