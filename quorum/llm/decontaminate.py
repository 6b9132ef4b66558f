"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

A document is contaminated by an item if some part of it is within the item's edit budget
(one edit per ``BUDGET`` characters) of the whole item.  By the q-gram lemma such a part
shares at least ``m - q + 1 - q * k`` q-grams with an item of ``m`` characters and ``k``
edits, all of them within ``k`` diagonals of each other.

1. hits: q-grams of the document that some item has, by a hash table of the items' q-grams;
2. hits that lie too sparsely for every length of item are dropped;
3. the rest are counted per item in overlapping bands of ``2 * (2k + 1)`` diagonals, so that
   any ``2k + 1`` neighbouring diagonals lie in one band; bands below the bound are dropped;
4. what is left is verified by an alignment restricted to the band, on the characters.

No step can lose a part within the budget.  Letters are compared without case (ASCII and
Latin-1), white space characters are all equal.  Items lie in the shared folder, dealt by hash
into blocks of about ``BLOCK_CHARS`` characters.  A task holds some megabytes of documents and
one block's index at a time, so neither it nor the driver ever holds the benchmark; documents
are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import batches, shared_files, tidy
from quorum.session import scratch_path

Q = 8
BUDGET = 12
SHORT = 32              # items below this length allow no edits
BLOCK_CHARS = 1 << 20   # characters of items in one index
CHUNK_BYTES = 16 << 20  # documents that meet one index after the other (at least one row)
_TABLE_BITS = 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BIG = 1 << 32

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[0xC0:0xDF] += 0x20
_FOLD[0xD7] = 0xD7
_FOLD[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0]] = 0x20


def budget(length: int) -> int:
    return length // BUDGET if length >= SHORT else 0


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """One byte per character for the filter, and the characters that alignment compares."""
    try:
        codes = _FOLD[np.frombuffer(text.encode("latin-1"), dtype=np.uint8)]
        return codes, codes
    except UnicodeEncodeError:
        wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
        low = wide < 256
        wide[low] = _FOLD[wide[low]]
        codes = np.where(low, wide, (wide * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
        return codes, wide


def grams(codes: np.ndarray) -> np.ndarray:
    """The q-gram at each position as one integer."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    raw = np.ascontiguousarray(codes)
    out = np.empty(n, dtype=np.uint64)
    for shift in range(min(Q, n)):
        count = (len(raw) - shift) // Q
        out[shift::Q] = np.frombuffer(raw.data, dtype="<u8", count=count, offset=shift)[:len(out[shift::Q])]
    return out


class Items:
    """The q-gram index of a block of items."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        kept = [(i, t) for i, t in items if t and not t.isspace()]
        self.ids = [i for i, _ in kept]
        both = [folded(t) for _, t in kept]
        self.codes, self.chars = [b[0] for b in both], [b[1] for b in both]
        length = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.edits = np.array([budget(n) for n in length], dtype=np.int64)
        self.need = length - Q + 1 - Q * self.edits
        self.tiny = [i for i, n in enumerate(length) if n < Q]
        all_grams = [grams(c) for c in self.codes]
        sizes = np.array([len(g) for g in all_grams], dtype=np.int64)
        flat = np.concatenate([*all_grams, np.empty(0, dtype=np.uint64)])
        item = np.repeat(np.arange(len(kept)), sizes)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        by = np.argsort(flat, kind="stable")
        self.item, self.at = item[by], at[by]
        self.grams, self.first, self.count = np.unique(flat[by], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self._slot(self.grams)] = True
        # (hits, span) of groups of similar lengths: what an occurrence must show at least.
        self.density: list[tuple[int, int]] = []
        order = np.argsort(length)
        order = order[length[order] >= Q]
        for part in np.array_split(order, 8):
            if len(part):
                self.density.append((int(self.need[part].min()), int((length[part] + self.edits[part]).max())))

    @staticmethod
    def _slot(grams_: np.ndarray) -> np.ndarray:
        return (grams_ * _MUL) >> np.uint64(64 - _TABLE_BITS)

    def _dense(self, hits: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(hits) + 1, dtype=np.int64)
        for need, span in self.density:
            if len(hits) >= need:
                first = np.flatnonzero(hits[need - 1:] - hits[:len(hits) - need + 1] <= span)
                if len(first):
                    keep += np.bincount(first, minlength=len(keep)) - np.bincount(first + need, minlength=len(keep))
        return hits[np.cumsum(keep[:-1]) > 0]

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, edits): the best occurrence in each run of bands that hold one."""
        if not text or not self.ids:
            return []
        codes, chars = folded(text)
        out = []
        for i in self.tiny:
            if (at := chars.tobytes().find(self.chars[i].astype(chars.dtype).tobytes())) >= 0 \
                    and at % chars.itemsize == 0 and self.chars[i].max() < _BIG:
                at //= chars.itemsize
                out.append((self.ids[i], at, at + len(self.chars[i]), 0))
        own = grams(codes)
        hits = np.flatnonzero(self.table[self._slot(own)])
        hits = self._dense(hits) if len(hits) else hits
        if not len(hits):
            return out
        slot = np.searchsorted(self.grams, own[hits])
        slot[slot == len(self.grams)] = 0
        known = self.grams[slot] == own[hits]
        hits, slot = hits[known], slot[known]
        count = self.count[slot]
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        posting = np.repeat(self.first[slot], count) + offset
        item = self.item[posting]
        diagonal = np.repeat(hits, count) - self.at[posting]
        step = 2 * self.edits[item] + 1
        band = diagonal // step
        stride = len(codes) + 3
        low = -(1 << 24)
        key = item * (2 * stride - low) + band - low
        keys, n = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        item = keys // (2 * stride - low)
        band = keys % (2 * stride - low) + low
        full = n >= self.need[item]
        item, band = item[full], band[full]
        if not len(item):
            return out
        cuts = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (band[1:] > band[:-1] + 1), [True]]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            found = self._align(chars, int(item[a]), int(band[a]), int(band[b - 1]))
            if found is not None:
                out.append((self.ids[item[a]], *found))
        return sorted(set(out), key=lambda x: (x[0] is None, x[0] or 0, x[1:]))

    def _align(self, text: np.ndarray, i: int, first: int, last: int) -> tuple[int, int, int] | None:
        """Best occurrence of item ``i`` on the diagonals of some bands, if within its budget.

        Columns are text positions relative to the lowest diagonal.  A cell is
        ``edits * 2**32 + start``, so one minimum carries both.
        """
        item, k = self.chars[i], int(self.edits[i])
        step = 2 * k + 1
        low, high = first * step - k, (last + 2) * step - 1 + k
        a, b = max(0, low), min(len(text), high + len(item))
        part, same = text[a:b], item.astype(text.dtype)
        if text.itemsize >= item.itemsize or item.max() < 256:
            at = part.tobytes().find(same.tobytes())
            if at >= 0 and at % text.itemsize == 0:
                return a + at // text.itemsize, a + at // text.itemsize + len(item), 0
        width = high - low + 1
        columns = np.arange(width, dtype=np.int64)
        inf = np.int64(1) << 60
        padded = np.full(len(item) + width, -1, dtype=np.int64)
        padded[a - low:b - low] = part
        start = low + columns
        row = np.where((start >= 0) & (start <= len(text)), start, inf)
        for r, c in enumerate(item.astype(np.int64).tolist()):
            nxt = row + np.where(padded[r:r + width] == c, 0, _BIG)
            nxt[:-1] = np.minimum(nxt[:-1], row[1:] + _BIG)
            row = np.minimum.accumulate(nxt - columns * _BIG) + columns * _BIG
            row[(low + r + 1 + columns < 0) | (low + r + 1 + columns > len(text))] = inf
        best = int(np.argmin(row))
        edits = int(row[best] // _BIG)
        if edits > k:
            return None
        return int(row[best] % _BIG), low + len(item) + best, edits


_MATCH = "array<struct<item_id: bigint, start: bigint, end: bigint, edits: bigint>>"
_ARROW = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "edits")]))


def _read_block(path: str, block: int) -> Items:
    """The index of one block of the items' table; a block that no item fell into is empty."""
    files, inner = shared_files(f"{path}/block={block}")
    found = files.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    items: list[tuple[int, str]] = []
    for name in sorted(f.path for f in found if f.base_name.endswith(".parquet")):
        table = pq.read_table(name, filesystem=files, columns=["item", "body"], partitioning=None)
        items += zip(table.column("item").to_pylist(), table.column("body").to_pylist(), strict=True)
    return Items(items)


def _chunks(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive small batches of about ``size`` bytes together."""
    held, total = [], 0
    for batch in batches(rows, 256):
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def _search(path: str, blocks: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for chunk in _chunks(rows, CHUNK_BYTES):
            found: list[list[list[tuple[int, int, int, int]]]] = [[[] for _ in range(b.num_rows)] for b in chunk]
            for block in range(blocks):
                if index is None or blocks > 1:
                    index = None        # one index at a time, also while the next is read
                    index = _read_block(path, block)
                for batch, matches in zip(chunk, found, strict=True):
                    for at, text in enumerate(batch.column(1).to_pylist()):
                        matches[at] += index.find(text)
            for batch, matches in zip(chunk, found, strict=True):
                named = [[dict(zip(("item_id", "start", "end", "edits"), m, strict=True)) for m in row] for row in matches]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(named, _ARROW),
                                                  *batch.columns[2:]], names=["id", "text", "matches", *batch.schema.names[2:]])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = (), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(id, text, matches, *carry)`` per row of ``docs``: where benchmark items occur in it.

    ``benchmark`` holds (item_id, text).  ``matches`` lists (item_id, start, end, edits) in
    character positions, the best occurrence of each run of bands, empty for clean rows.

    Defined cases: null, empty or blank items match nothing, nor does a null or empty text;
    items below ``SHORT`` characters must occur without edits; repeated items are reported
    once each by their id, a null item id as null; of equally good occurrences in a run of
    bands the first is listed; null ids, repeated rows, an empty table on either side and
    further columns are fine.  A very long text is searched whole, alone in its chunk: a task
    holds a few times its size.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       *(F.col(c) for c in carry))
    schema = f"id long, text string, matches {_MATCH}" + "".join(
        f", `{c}` {base.schema[c].dataType.simpleString()}" for c in carry)
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("body")) \
        .filter("body is not null").distinct()
    chars = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    path = scratch_path(docs.sparkSession, "items")
    items.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks))) \
        .repartition("block").write.partitionBy("block").parquet(path)
    return base.mapInArrow(tidy("decontaminate", _search(path, blocks)), schema)
