"""MinHash near-duplicates by an LSH forest.

Every distinct shingle set gets one signature of minima.  The forest's trees are sorted
orders of the signatures, each taking the minima in another sequence.  An order is sorted by
ranges over the cluster, each row is compared with the rows before and after it, and only rows
whose longest common prefix with a neighbour reaches the level's depth go on; rows that share
that prefix are a region.

The depth adapts to the region.  ``LEVELS`` names depths and the number of orders that finds a
pair at similarity 0.8 with a miss of at most 1e-5 there (a deeper prefix is shared more
rarely, so it needs more orders):

* at most ``pair_region`` sets: every pair of the region is a candidate; candidates of all
  orders meet in one distinct, are thinned by their signatures and confirmed on full texts;
* more, at most ``task_region`` sets: one task confirms the region exactly by an inverted
  list of its shingles and returns a spanning forest of its links, never its pairs;
* still more: the sets are compared with one leader of the region, part by part.  Those
  linked to it need no further comparison with each other; as the Jaccard distance is a
  metric, only sets within twice the allowed distance of the leader can link to them.  The
  sets that are left to compare go on to the next level: its orders are sorted over them alone,
  by a deeper prefix;
* the same beyond the last level's depth: blocks of the region go against each other, each pair
  of blocks in one task.  The work grows with the square of the sets that agree in that whole
  prefix and are not linked to their leader, and with nothing else.

Equal sets collapse to one row before any of this, by a partial aggregate, so a group of
exact copies of any size costs one row.  A very long text is read whole, in blocks, by the task
that holds it; ties between orders or leaders change no link, as links are confirmed exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import binaries, components, cut, tidy, tidy_group
from quorum.llm.shingles import MinHash, mix, shared, shingle_set

SIZE = 64
# (depth, orders): (1 - 0.8 ** depth) ** orders is at most 1e-5.
LEVELS = ((3, 16), (5, 32), (8, 64))
PAIR_REGION = 32
TASK_REGION = 4096
TASK_SHINGLES = 4_000_000
# Two sets at Jaccard 0.8 share 51 of 64 minima on average (deviation 3.2): the floor of 37 is
# more than four deviations below.
SLACK = 0.22


def _features(k: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(SIZE)
        for batch in rows:
            n, prints, sigs = [], [], []
            for text in binaries(batch.column(1)):
                found = shingle_set(text, k)
                n.append(len(found))
                prints.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sigs.append(minhash.of(found).view(np.int32) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(sigs, pa.list_(pa.int32()))], names=["id", "n", "fp", "sig"])
    return run


def features(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(id, n, fp, sig)`` per row: set size, 128-bit digest of the set, its minima."""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")) \
        .mapInArrow(tidy("minhash", _features(k)), "id long, n long, fp binary, sig array<int>")


def sequences(depth: int, orders: int) -> np.ndarray:
    """The first ``depth`` minima of each order: random permutations of all minima, each cut
    into as many orders as it holds, so that orders overlap only where they must."""
    rng = np.random.default_rng(depth)
    per = SIZE // depth
    cuts = [rng.permutation(SIZE)[:per * depth].reshape(per, depth) for _ in range(-(-orders // per))]
    return np.concatenate(cuts)[:orders]


def _ordered(depth: int, orders: int):
    """``(tree, prefix, rep, n)``: a row per order, its prefix as bytes that sort like it."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = sequences(depth, orders)
        for batch in rows:
            if not batch.num_rows:
                continue
            sigs = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, SIZE)
            for tree, minima in enumerate(taken):
                raw = np.ascontiguousarray(sigs[:, minima].view(np.uint32).astype(">u4"))
                prefix = pa.Array.from_buffers(pa.binary(4 * depth), batch.num_rows, [None, pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, tree, dtype=np.int32)), prefix.cast(pa.binary()),
                     batch.column(0), batch.column(1)], names=["tree", "prefix", "rep", "n"])
    return run


def _neighbours(depth: int):
    """``(key, rep, n)`` of the rows of a sorted stretch whose longest common prefix with the
    row before or after has the whole depth; a stretch's first and last row have a neighbour
    that the task does not see, and stay."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: np.ndarray | None = None
        held: tuple | None = None           # the last row so far: (values, rep, n, joined)

        def out(values: np.ndarray, rep: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            key = values[:, 0].astype(np.uint64)
            for i in range(1, values.shape[1]):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, i].astype(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(rep), pa.array(n)],
                                              names=["key", "rep", "n"])

        for batch in rows:
            size = batch.num_rows
            if not size:
                continue
            raw = b"".join(batch.column(1).to_pylist())
            values = np.empty((size, depth + 1), dtype=np.uint32)
            values[:, 0] = batch.column(0).to_numpy()
            values[:, 1:] = np.frombuffer(raw, dtype=">u4").reshape(size, depth)
            rep, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            # Length of the common prefix of neighbours, the order's number included.
            before = np.full(size, depth + 1)
            before[1:] = np.cumprod(values[1:] == values[:-1], axis=1).sum(axis=1)
            if held is not None:
                before[0] = np.cumprod(values[0] == last).sum()
                if held[3] or before[0] > depth:
                    yield out(*held[:3])
            joined = before > depth
            keep = joined[:-1] | joined[1:]
            yield out(values[:-1][keep], rep[:-1][keep], n[:-1][keep])
            last, held = values[-1], (values[-1:], rep[-1:], n[-1:], bool(joined[-1]))
        if held is not None:
            yield out(*held[:3])
    return run


def _regions(rows: DataFrame, depth: int, orders: int) -> DataFrame:
    """``(key, rep, n, members, shingles, leader)`` of the regions of a level's orders."""
    near = rows.select("rep", "n", "sig") \
        .mapInArrow(tidy("minhash", _ordered(depth, orders)), "tree int, prefix binary, rep long, n long") \
        .repartitionByRange("tree", "prefix").sortWithinPartitions("tree", "prefix") \
        .mapInArrow(tidy("minhash", _neighbours(depth)), "key long, rep long, n long")
    near = cut(near, "neighbours")
    sizes = near.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"),
                                    F.min_by("rep", F.xxhash64("rep")).alias("leader")).filter("members > 1")
    return cut(near.join(sizes, "key"), "regions")


def _region_links(k: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        texts = binaries(table.column("text").combine_chunks())
        sets = [shingle_set(texts[i], k) for i in order]
        ids = ids[order]
        sizes = np.array([len(s) for s in sets])
        _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(sets)), sizes)
        by = np.argsort(shingle, kind="stable")
        owner = owner[by]
        first = np.concatenate([[0], np.cumsum(np.bincount(shingle))])
        label = np.arange(len(sets))
        for i in range(1, len(sets)):
            own = shingle[offsets[i]:offsets[i + 1]]
            own = own[first[own + 1] - first[own] > 1]
            if not len(own):
                continue
            common = np.bincount(np.concatenate([owner[first[s]:first[s + 1]] for s in own]),
                                 minlength=len(sets))[:i]
            linked = np.flatnonzero(100 * common >= percent * (sizes[i] + sizes[:i] - common))
            if len(linked):
                merged = np.unique(np.append(label[linked], label[i]))
                label[np.isin(label, merged)] = merged[0]
        return pa.table({"u": ids, "v": ids[label]}).filter(pa.array(ids != ids[label]))
    return run


def _star(k: int, percent: int):
    """``(key, rep, leader, role)``: 0 linked to the leader, 1 near enough to link to a row of
    role 0, 2 neither.  With several texts of an id, role 0 needs all and role 1 any."""
    def run(table: pa.Table) -> pa.Table:
        ids, lead = table.column("rep").to_numpy(), table.column("leads").to_numpy(zero_copy_only=False)
        sets = [shingle_set(t, k) for t in binaries(table.column("text").combine_chunks())]
        leaders = [s for s, yes in zip(sets, lead, strict=True) if yes]
        near, margin = {}, {}
        for rep, found in ((int(r), s) for r, s, yes in zip(ids, sets, lead, strict=True) if not yes):
            for own in leaders:
                common = shared(own, found)
                union = len(own) + len(found) - common
                near[rep] = near.get(rep, True) and 100 * common >= percent * union
                margin[rep] = margin.get(rep, False) or 100 * common >= (2 * percent - 100) * union
        role = [0 if near[r] else 1 if margin[r] else 2 for r in near]
        one = lambda name: [table.column(name)[0].as_py()] * len(near)
        return pa.table({"key": pa.array(one("key"), pa.int64()), "rep": pa.array(list(near), pa.int64()),
                         "leader": pa.array(one("leader"), pa.int64()), "role": pa.array(role, pa.int32())})
    return run


def _block_links(k: int, percent: int):
    """A spanning forest of the links between the sets of two blocks."""
    def run(table: pa.Table) -> pa.Table:
        ids, asks = table.column("rep").to_numpy(), table.column("asks").to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, asks))
        ids, n = ids[order], int((~asks).sum())
        texts = binaries(table.column("text").combine_chunks())
        sets = [shingle_set(texts[i], k) for i in order]
        sizes = np.array([len(s) for s in sets])
        if not n or n == len(sets):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        shingles = np.concatenate(sets[:n])
        owner = np.repeat(np.arange(n), sizes[:n])[np.argsort(shingles, kind="stable")]
        shingles, first = np.unique(shingles, return_counts=True)
        first = np.concatenate([[0], np.cumsum(first)])
        label = np.arange(len(sets))
        for i in range(n, len(sets)):
            at = np.searchsorted(shingles, sets[i])
            at = at[shingles[np.minimum(at, len(shingles) - 1)] == sets[i]]
            if not len(at):
                continue
            common = np.bincount(np.concatenate([owner[first[s]:first[s + 1]] for s in at]), minlength=n)
            linked = np.flatnonzero((common > 0) & (100 * common >= percent * (sizes[i] + sizes[:n] - common)))
            if len(linked):
                merged = np.unique(np.append(label[linked], label[i]))
                label[np.isin(label, merged)] = merged[0]
        return pa.table({"u": ids, "v": ids[label]}).filter(pa.array(ids != ids[label]))
    return run


def _confirm(k: int, percent: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            a, b = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            keep, last, own = [], None, None
            for x, y in zip(binaries(batch.column(1)), binaries(batch.column(3)), strict=True):
                if x is not last and x != last:
                    last, own = x, shingle_set(x, k)
                other = shingle_set(y, k)
                common = shared(own, other)
                keep.append(common > 0 and 100 * common >= percent * (len(own) + len(other) - common))
            keep = np.array(keep, dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["u", "v"])
    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs ``(u, v)`` whose full texts reach the similarity.

    Both joins share one exchange of the texts, at every size of the pairs.
    """
    texts = texts.hint("merge")
    return pairs.join(texts.select(F.col("rep").alias("v"), F.col("text").alias("tv")), "v") \
        .join(texts.select(F.col("rep").alias("u"), F.col("text").alias("tu")), "u") \
        .select("u", "tu", "v", "tv").mapInArrow(tidy("minhash", _confirm(k, percent)), "u long, v long")


def _parts(sets: str, shingles: str, task_region: int, task_shingles: int) -> Column:
    """Blocks of a region, of which two make a task."""
    return F.ceil(F.greatest(2 * F.col(sets) / task_region, 2 * F.col(shingles) / task_shingles)).cast("long")


def _led(rest: DataFrame, texts: DataFrame, k: int, percent: int, task_region: int,
         task_shingles: int) -> tuple[DataFrame, DataFrame]:
    """Regions beyond a task, ``rest`` (key, rep, n, members, shingles, leader), against one
    leader each: the links to it, and ``(key, rep, n, role)`` of all their sets."""
    part = F.pmod(F.xxhash64("rep"), F.col("parts"))
    one = rest.groupBy("key", "rep").agg(F.sum("n").alias("n"), F.first("leader").alias("leader"),
                                         F.first("members").alias("members"), F.first("shingles").alias("shingles")) \
        .withColumn("parts", _parts("members", "shingles", task_region, task_shingles))
    followers = one.filter("rep <> leader").select("key", part.alias("part"), "rep", "leader", F.lit(False).alias("leads"))
    leaders = one.filter("rep = leader").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                                                "rep", "leader", F.lit(True).alias("leads"))
    star = cut(followers.union(leaders).join(texts, "rep").groupBy("key", "part")
               .applyInArrow(tidy_group("minhash", _star(k, percent)), "key long, rep long, leader long, role int"), "star")
    roles = one.join(star.select("key", "rep", "role"), ["key", "rep"], "left") \
        .select("key", "rep", "n", F.coalesce("role", F.lit(0)).alias("role"))
    return star.filter("role = 0").select(F.col("leader").alias("u"), F.col("rep").alias("v")), cut(roles, "led")


def _to_compare(roles: DataFrame) -> DataFrame:
    """``rep`` of the sets that their leaders leave to compare: those not linked to one, and
    those linked to one that has sets near enough to link to them."""
    near = roles.filter("role = 1").select("key").distinct()
    return roles.filter("role > 0").select("rep") \
        .union(roles.filter("role = 0").join(near, "key", "left_semi").select("rep")).distinct()


def _blocks(roles: DataFrame, texts: DataFrame, k: int, percent: int, task_region: int,
            task_shingles: int) -> tuple[DataFrame, DataFrame]:
    """Links across the blocks of led regions, and the blocks ``(key, rep)`` that are still to
    be compared within."""
    counts = []
    for name, which in (("owned", "role = 0"), ("near", "role = 1"), ("open", "role > 0")):
        where = F.expr(which)
        counts += [F.count(F.when(where, 1)).alias(f"{name}_sets"), F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)).alias(f"{name}_n")]
    sized = roles.groupBy("key").agg(*counts)
    for name in ("owned", "near", "open"):
        sized = sized.withColumn(name, _parts(f"{name}_sets", f"{name}_n", task_region, task_shingles))
    roles = cut(roles.join(sized.select("key", "owned", "near", "open"), "key"), "roles")

    def number(name: str) -> Column:
        return F.pmod(F.xxhash64("rep"), F.col(name))

    def every(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))

    open_ = roles.filter("role > 0").withColumn("part", number("open"))
    across = open_.withColumn("other", every("open")).filter("part <> other") \
        .select("key", F.lit(0).alias("kind"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                "rep", (F.col("part") > F.col("other")).alias("asks"))
    near = roles.filter("role = 1").withColumn("i", number("near")).withColumn("j", every("owned")) \
        .select("key", F.lit(1).alias("kind"), "i", "j", "rep", F.lit(True).alias("asks"))
    owned = roles.filter("role = 0 and near > 0").withColumn("j", number("owned")).withColumn("i", every("near")) \
        .select("key", F.lit(1).alias("kind"), "i", "j", "rep", F.lit(False).alias("asks"))
    blocks = across.union(near).union(owned).join(texts, "rep").groupBy("key", "kind", "i", "j") \
        .applyInArrow(tidy_group("minhash", _block_links(k, percent)), "u long, v long")
    return blocks, open_.select(F.xxhash64("key", "part").alias("key"), "rep")


def links(classes: DataFrame, texts: DataFrame, k: int, percent: int,
          pair_region: int = PAIR_REGION, task_region: int = TASK_REGION,
          task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """Confirmed links ``(u, v)`` that span the components of the classes.

    ``classes``: (rep, n, sig); ``texts``: (rep, text), a text of each class.
    """
    edges, pairs = [], []
    rows = classes
    for level, (depth, orders) in enumerate(LEVELS):
        found = _regions(rows, depth, orders)
        small = found.filter(F.col("members") <= pair_region).select("key", "rep")
        pairs.append(small.select("key", F.col("rep").alias("u"))
                     .join(small.select("key", F.col("rep").alias("v")), "key").filter("u < v").select("u", "v"))
        fits = (F.col("members") <= task_region) & (F.col("shingles") <= task_shingles)
        middle = found.filter((F.col("members") > pair_region) & fits).select("key", "rep")
        rest = found.filter((F.col("members") > pair_region) & ~fits)
        deeper = not rest.isEmpty()
        if deeper:
            star, roles = _led(rest, texts, k, percent, task_region, task_shingles)
            edges.append(star)
            if level + 1 < len(LEVELS):
                rows = cut(classes.join(_to_compare(roles), "rep", "left_semi"), "deeper")
                deeper = not rows.isEmpty()
            else:
                across, within = _blocks(roles, texts, k, percent, task_region, task_shingles)
                edges.append(across)
                middle = middle.union(within)
        if not middle.isEmpty():
            edges.append(middle.join(texts, "rep").groupBy("key")
                         .applyInArrow(tidy_group("minhash", _region_links(k, percent)), "u long, v long"))
        if not deeper:
            break
    candidates = reduce(DataFrame.union, pairs)
    # Thinned by set sizes and by one byte of each minimum, exact in what they rule out but
    # for the signature's own error.
    floor = int(SIZE * (percent / 100 - SLACK))
    alike = F.expr("size(filter(zip_with(su, sv, (x, y) -> x = y), z -> z))")
    sketch = classes.select("rep", "n", F.transform("sig", lambda m: F.shiftright(m, 24).cast("byte")).alias("s"))
    thinned = candidates.distinct() \
        .join(sketch.select(F.col("rep").alias("v"), F.col("n").alias("nv"), F.col("s").alias("sv")), "v") \
        .join(sketch.select(F.col("rep").alias("u"), F.col("n").alias("nu"), F.col("s").alias("su")), "u") \
        .filter(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")) \
        .filter(alike >= floor).select("u", "v").distinct()
    edges.append(_confirmed(cut(thinned, "pairs"), texts, k, percent))
    return reduce(DataFrame.union, edges)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80, **regions) -> DataFrame:
    """One row per row of ``docs``: ``(id, n_shingles, component_id, kept)``.

    Two rows are linked when ``100 * |A & B| >= percent * |A | B|`` over their sets of
    ``k``-word shingles.  ``component_id`` is the smallest id reachable, ``kept`` tells
    whether it is the row's own.

    Defined cases: a null or wordless text has no shingles and links with nothing; a text
    of fewer than ``k`` words is one shingle; rows that repeat an id are one document, and
    each returns a row; a row with a null id links with nothing that needs its name: its
    component is that of its equal copies with an id, else null, and it counts as kept only
    in the latter case.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = cut(features(docs, id_col, text_col, k), "features")
    classes = cut(rows.filter("fp is not null").groupBy("fp")
                  .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    named = classes.filter("rep is not null")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text")) \
        .filter("rep is not null and text is not null")
    found = links(named.select("rep", "n", "sig"), texts, k, percent, **regions)
    # An id that carries several texts is one document: it links the classes of its rows.
    repeated = rows.groupBy("id").count().filter("id is not null and count > 1")
    several = rows.join(repeated, "id", "left_semi").join(named.select("fp", "rep"), "fp")
    several = several.join(several.groupBy("id").agg(F.min("rep").alias("u")), "id") \
        .select("u", F.col("rep").alias("v")).filter("u <> v")
    label = components(found.union(several))
    labelled = named.select("fp", "rep").join(label, F.col("rep") == F.col("node"), "left") \
        .select("fp", F.coalesce("component", "rep").alias("component"))
    out = rows.join(labelled, "fp", "left")
    return out.select(F.col("id"), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()))
