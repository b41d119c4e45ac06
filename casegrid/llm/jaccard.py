"""N-gram Jaccard join: token groups, a count-vector R-tree, exact verification.

Shingles are hashed into groups, twice.

* For meeting.  Two sets with J >= t differ in at most
  d = (1 - t) / (1 + t) * (|A| + |B|) shingles.  With more groups than d, some
  group that is not empty must hold the same shingles in both, so the content of
  a group is the key under which sets meet.  A set whose filled groups are not
  more than d also emits the groups of a further hash, until they are: whichever
  of the two is smaller, both have emitted the hash that decides, so no link is
  lost.  A frequent passage does not make a hot key, since other shingles of the
  document share its groups; near copies do.
* For pruning.  The number of shingles in each of 128 groups is a point.  The
  overlap of two sets is at most the sum of the coordinate minima of their
  points; over the boxes of a packed R-tree the same sum bounds every pair below.

Sets that meet are linked in rounds.  The first verifies neighbours in the sorted
list of a key, which connects most near copies with few pairs.  Each further one
takes, in each key, the pairs that the links so far leave apart, prunes them in
the tree, and verifies the rest: all of them, or only the nearest few of each
member where there are many, and then another round follows, with all pairs once
the nearest bring no link.  In the end every pair of sets that meet is verified
or connected, so the components are exact; pairs inside one component are never
made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from casegrid.operators.components import connected_components
from casegrid.session import materialize

from .common import lookup, partitions

SHINGLE = 4
THRESHOLD = 85
#: Width of the size classes; any factor gives the same links.
CLASS_RATIO = 1.35
#: Coordinates of a point.
GROUPS = 256
#: Largest count of a coordinate.  A set with more in a group gets it in all, a
#: point that covers every other; beyond GROUPS * COUNT_TOP shingles nothing is pruned.
COUNT_TOP = 2**16 - 1
#: A group of a key gives out all pairs that may link if they are not more than
#: this many times its members, else the nearest pairs of each member.
PAIRS_PER_MEMBER, NEAREST = 2, 1
#: Rows of one key and component side by side in a task; larger ones are dealt out in blocks.
BLOCK = 1024
#: Entries of a node of the tree.
FANOUT = 16
#: Distinct words whose hashes a task keeps; the cache is emptied beyond.
WORD_CACHE = 500_000
NO_ID = 2**63 - 1
DIGEST = ["d1", "d2", "n"]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with well spread bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text: str | None, hashes: dict, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a short text is one shingle.

    Splitting bytes at ASCII white space is the split at [\\x20\\x09-\\x0D].
    """
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(ids))
    out = np.full(len(ids) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mix(out * np.uint64(31) + ids[k : k + len(out)])
    return np.unique(out)


def most_apart(a: int, b: int, threshold: int = THRESHOLD) -> int:
    """The largest symmetric difference of linked sets of sizes a and b."""
    return (100 - threshold) * (a + b) // (100 + threshold)


def _class_tops() -> list[int]:
    tops, low = [], 1
    while low < 2**40:
        high = max(low + 1, int(low * CLASS_RATIO))
        tops.append(high - 1)
        low = high
    return tops


#: Largest size of each class.
CLASS_TOPS = _class_tops()


def group_keys(shingles: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Keys under which a set meets every set it can be linked with.

    Pairs meet in the class of the smaller set, so a set emits its own class and
    every lower one in which it may be the larger partner.
    """
    from bisect import bisect_left

    n, found = len(shingles), []
    own = bisect_left(CLASS_TOPS, n)
    for k in range(own, -1, -1):
        top = CLASS_TOPS[k]
        if 100 * top < threshold * n:
            break
        apart = most_apart(n, 100 * n // threshold if k == own else top, threshold)
        if apart == 0:
            continue  # only equal sets are linked, and those are one set
        groups = most_apart(top, 100 * top // threshold, threshold) * 21 // 20 + 3
        for attempt in range(64):
            x = _mix(shingles + np.uint64(1 + k + (attempt << 20)))
            group = ((x >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            group = group[order]
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            content = np.add.reduceat(_mix(x[order] + np.uint64(0x9E3779B97F4A7C15)), starts)
            name = (group[starts].astype(np.uint64) << np.uint64(16)) + np.uint64(k + (attempt << 10))
            found.append(_mix(content ^ _mix(name)))
            if len(starts) > apart:
                break
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def count_point(shingles: np.ndarray) -> np.ndarray:
    group = (_mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) % GROUPS
    counts = np.bincount(group, minlength=GROUPS)
    return np.where(counts.max(initial=0) > COUNT_TOP, COUNT_TOP, counts).astype("<u2")


def overlap_enough(overlap, a, b, threshold: int = THRESHOLD):
    """100 * overlap >= threshold * union."""
    return (100 + threshold) * overlap >= threshold * (a + b)


def may_link(bound, a, b, threshold: int = THRESHOLD):
    """Whether an upper bound of the overlap leaves a link possible."""
    return overlap_enough(bound, a, b, threshold) | (np.minimum(a, b) > GROUPS * COUNT_TOP)


class CountTree:
    """A packed R-tree over count points: boxes of FANOUT entries, level on level.

    A node keeps the largest coordinates and the range of sizes below it, which
    is all that an upper bound of the overlap needs.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        heavy = points.astype(np.int64)
        lead = np.argmax(heavy, 1) if len(heavy) else np.empty(0, np.int64)
        self.order = np.lexsort((lead, sizes, comps))
        points, sizes, comps = points[self.order], sizes[self.order], comps[self.order]
        self.levels = [(points, sizes, sizes, comps, comps)]
        while len(points) > 1:
            at = np.arange(0, len(points), FANOUT)
            low, high, first, last = self.levels[-1][1:]
            points = np.maximum.reduceat(points, at)
            level = (
                points, np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                np.minimum.reduceat(first, at), np.maximum.reduceat(last, at),
            )
            self.levels.append(level)

    def pairs(self, other: CountTree, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
        """Positions (in the original order) of the pairs of entries that may be
        linked and are in different components."""
        top = max(len(self.levels), len(other.levels)) - 1
        mine, its = [np.zeros(1, np.int64)] * 2
        for depth in range(top, -1, -1):
            a = self.levels[min(depth, len(self.levels) - 1)]
            b = other.levels[min(depth, len(other.levels) - 1)]
            keep = [np.empty((2, 0), np.int64)]
            for at in range(0, len(mine), 65_536):
                i, j = mine[at : at + 65_536], its[at : at + 65_536]
                apart = ~((a[3][i] == a[4][i]) & (b[3][j] == b[4][j]) & (a[3][i] == b[3][j]))
                near = (100 * a[2][i] >= threshold * b[1][j]) & (100 * b[2][j] >= threshold * a[1][i])
                i, j = i[apart & near], j[apart & near]
                bound = np.minimum(a[0][i], b[0][j]).sum(1)
                ok = may_link(bound, a[1][i], b[1][j], threshold)
                if self is other:
                    ok &= i <= j
                keep.append(np.stack([i[ok], j[ok]]))
            mine, its = np.concatenate(keep, 1)
            if depth == 0:
                break
            mine, its = _children(mine, its, self._below(depth), other._below(depth))
        return self.order[mine], other.order[its]

    def _below(self, depth: int) -> int | None:
        """Entries one level down; None where the tree is already at its top there."""
        return len(self.levels[depth - 1][0]) if depth < len(self.levels) else None


def _children(i: np.ndarray, j: np.ndarray, below_i: int | None, below_j: int | None):
    def step(x, below):
        if below is None:
            return x[:, None]
        return x[:, None] * FANOUT + np.arange(FANOUT)

    a, b = step(i, below_i), step(j, below_j)
    left = np.repeat(a, b.shape[1], 1).ravel()
    right = np.tile(b, (1, a.shape[1])).ravel()
    ok = np.ones(len(left), bool)
    if below_i is not None:
        ok &= left < below_i
    if below_j is not None:
        ok &= right < below_j
    return left[ok], right[ok]


# --- tasks -------------------------------------------------------------------------

def _digest(shingles: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_128_intdigest(shingles.tobytes())


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _sets_kernel(threshold: int, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            rows = []
            for doc, copy, text in zip(batch["doc_id"], batch["copy"], batch["text"], strict=True):
                s = shingle_set(text, hashes, size)
                d = _digest(s)
                keys = group_keys(s, threshold).view(np.int64) if len(s) else ()
                rows.append((doc, copy, len(s), _signed(d >> 64), _signed(d & (2**64 - 1)), keys))
            yield pd.DataFrame(rows, columns=["doc_id", "copy", "n", "d1", "d2", "keys"])

    return run


def _points_kernel(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            rows = []
            for node, text in zip(batch["node"], batch["text"], strict=True):
                s = shingle_set(text, hashes, size)
                rows.append((node, len(s), count_point(s).tobytes(), s.view(np.int64)))
            yield pd.DataFrame(rows, columns=["node", "n", "point", "shingles"])

    return run


def _runs_kernel():
    """Sorted (key, d1) rows: those whose key has another set in this task, and
    those at the ends of the task, whose key may go on next door.  `before` is
    the set in front of it under the same key, where `linked`."""

    def frame(key, d1, at, linked):
        before = d1[np.maximum(at - 1, 0)]
        return pd.DataFrame({"key": key[at], "d1": d1[at], "before": before, "linked": linked[at]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = d1 = np.empty(0, np.int64)  # the last row, not given out yet, and the one before it
        first = True
        for batch in batches:
            key, d1 = np.r_[key, batch["key"].to_numpy()], np.r_[d1, batch["d1"].to_numpy()]
            new = np.r_[True, (key[1:] != key[:-1]) | (d1[1:] != d1[:-1])][: len(key)]
            key, d1 = key[new], d1[new]
            if len(key) < 2:
                continue
            same = key[1:] == key[:-1]
            linked = np.r_[False, same]
            keep = linked[:-1] | same
            keep[0] = first
            at = np.flatnonzero(keep)
            if len(at):
                yield frame(key, d1, at, linked)
            key, d1, first = key[-2:], d1[-2:], False
        if len(key):
            linked = np.r_[False, key[1:] == key[:-1]]
            yield frame(key, d1, np.array([len(key) - 1]), linked)

    return run


def _crossing(sizes, comps, sides, points, threshold):
    """Pairs of one group from different components that the tree leaves."""
    one, two = np.flatnonzero(sides <= 0), np.flatnonzero(sides > 0)
    tree = CountTree(points[one], sizes[one], comps[one])
    other = CountTree(points[two], sizes[two], comps[two]) if len(two) else tree
    a, b = tree.pairs(other, threshold)
    return one[a], (two if len(two) else one)[b]


def _nearest(a, b, sizes, points):
    """The NEAREST pairs of every member, by bounded overlap against size."""
    near = np.concatenate([
        np.minimum(points[a[i : i + 16_384]], points[b[i : i + 16_384]]).sum(1)
        for i in range(0, len(a), 16_384)
    ]) / (sizes[a] + sizes[b])
    keep = np.zeros(len(a), bool)
    for ends in (a, b):
        order = np.lexsort((-near, ends))
        own = ends[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        rank = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
        keep[order[rank < NEAREST]] = True
    return a[keep], b[keep]


def _leaf_pairs(group, sizes, comps, points, threshold):
    """The same for groups of a leaf's size, many at a time."""
    found = [np.empty((2, 0), np.int64)]
    for step in range(1, FANOUT):
        i = np.flatnonzero(group[:-step] == group[step:])
        if not len(i):
            break
        j = i + step
        low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        ok = (comps[i] != comps[j]) & (100 * low >= threshold * high)
        i, j = i[ok], j[ok]
        for at in range(0, len(i), 16_384):
            x, y = i[at : at + 16_384], j[at : at + 16_384]
            bound = np.minimum(points[x], points[y]).sum(1)
            ok = may_link(bound, sizes[x], sizes[y], threshold)
            found.append(np.stack([x[ok], y[ok]]))
    return np.concatenate(found, 1)


def _apart_kernel(threshold: int, every: bool):
    """Rows sorted by (key, pair, side): pairs across components that the bound
    leaves, `cut` where a group has more than it gives out (never with `every`)."""

    def split(batch, starts, ends, seen):
        nodes, sizes = batch["node"].to_numpy(), batch["n"].to_numpy()
        comps, sides = batch["comp"].to_numpy(), batch["side"].to_numpy()
        points = np.frombuffer(b"".join(batch["point"]), "<u2").reshape(-1, GROUPS).astype(np.int32)
        length = ends - starts
        small = np.flatnonzero((length > 1) & (length <= FANOUT))
        rows = np.concatenate([np.arange(starts[g], ends[g]) for g in small] or [np.empty(0, np.int64)])
        group = np.repeat(small, length[small])
        found = [rows[_leaf_pairs(group, sizes[rows], comps[rows], points[rows], threshold)]]
        cuts = [np.zeros(found[0].shape[1], bool)]
        for g in np.flatnonzero(length > FANOUT):
            at = slice(starts[g], ends[g])
            a, b = _crossing(sizes[at], comps[at], sides[at], points[at], threshold)
            cut = not every and len(a) > PAIRS_PER_MEMBER * length[g]
            if cut:
                a, b = _nearest(a, b, sizes[at], points[at])
            found.append(np.stack([a, b]) + starts[g])
            cuts.append(np.full(len(a), cut))
        a, b = nodes[np.concatenate(found, 1)]
        rows = zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), np.concatenate(cuts).tolist(), strict=True)
        pairs = {*rows} - seen
        if len(seen) > 200_000:
            seen.clear()
        seen |= pairs
        return pd.DataFrame(sorted(pairs), columns=["a", "b", "cut"]).astype({"a": "int64", "b": "int64", "cut": bool})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, seen = None, set()
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            ids = batch[["key", "pair"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(1)][: len(ids)])
            if len(starts) > 1:
                yield split(batch.iloc[: starts[-1]], starts[:-1], starts[1:], seen)
            rest = batch.iloc[starts[-1] :] if len(starts) else batch
        if rest is not None and len(rest):
            yield split(rest, np.zeros(1, np.int64), np.array([len(rest)]), seen)

    return run


# --- plan --------------------------------------------------------------------------

def _number(doc_id: str) -> Column:
    """The id, NULL as the largest number."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))


def _copy(text: str) -> Column:
    """Equal for equal texts; with the id, what tells rows apart."""
    return F.coalesce(F.md5(text), F.lit(""))


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(_number(doc_id).alias("doc_id"), _copy(text).alias("copy"), F.col(text).alias("text"))


def shingle_sets(docs: DataFrame, text: str, doc_id: str, threshold: int, size: int) -> DataFrame:
    """doc_id and copy of each row, n, 128-bit digest of the set, meeting keys."""
    return _texts(docs, text, doc_id).mapInPandas(
        _sets_kernel(threshold, size), "doc_id long, copy string, n long, d1 long, d2 long, keys array<long>"
    )


def _meetings(sets: DataFrame) -> DataFrame:
    """(key, d1, before, linked) of the keys that more than one set has."""
    spark = sets.sparkSession
    rows = sets.select(F.explode("keys").alias("key"), "d1")
    runs = materialize(
        rows.repartitionByRange(partitions(spark), "key", "d1")
        .sortWithinPartitions("key", "d1")
        .mapInPandas(_runs_kernel(), "key long, d1 long, before long, linked boolean")
    )
    shared = runs.groupBy("key").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).filter("lo <> hi")
    return materialize(runs.join(shared.select("key"), "key", "left_semi"))


def _verified(pairs: DataFrame, points: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) that pass the bound and then the exact test."""
    def side(name, *cols):
        return points.select(F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in cols))

    # The bound of the first round: points only, before any set is moved.
    near = pairs.join(side("a", "n", "point"), "a").join(side("b", "n", "point"), "b")
    near = materialize(
        near.mapInPandas(_bound_kernel(threshold), "a long, b long")
    )
    sets = near.join(side("a", "n", "shingles"), "a").join(side("b", "n", "shingles"), "b")
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return sets.filter(
        F.lit(100 + threshold) * common >= F.lit(threshold) * (F.col("a_n") + F.col("b_n"))
    ).select("a", "b")


def _bound_kernel(threshold: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a, b = (
                np.frombuffer(b"".join(batch[c]), "<u2").reshape(len(batch), GROUPS)
                for c in ("a_point", "b_point")
            )
            bound = np.minimum(a, b).sum(1, dtype=np.int64)
            ok = may_link(bound, batch["a_n"].to_numpy(), batch["b_n"].to_numpy(), threshold)
            yield batch.loc[ok, ["a", "b"]]

    return run


def _blocked(rows: DataFrame) -> DataFrame:
    """Deal the rows of a large key out in blocks, each pair of blocks one group.

    Blocks hold one component where it is large, so blocks of the same component
    are never paired with each other.  `side` tells the two blocks of a pair
    apart; 0 where there is one block.
    """
    own = rows.groupBy("key", "comp").agg(F.count("*").alias("in_comp"))
    sizes = own.groupBy("key").agg(
        F.sum("in_comp").alias("in_key"),
        F.sum(F.when(F.col("in_comp") < BLOCK, F.col("in_comp")).otherwise(0)).alias("in_rest"),
    )
    large = sizes.filter(F.col("in_key") > BLOCK)
    small_rows = rows.join(large.select("key"), "key", "left_anti").withColumns(
        {"pair": F.lit(0).cast("long"), "side": F.lit(0)}
    )
    of_large = rows.join(large, "key").join(own, ["key", "comp"])
    spread = lambda n: F.pmod(F.xxhash64("node"), F.ceil(n / F.lit(BLOCK)))
    own_block = F.xxhash64("comp", spread(F.col("in_comp")))
    block = F.when(F.col("in_comp") >= BLOCK, own_block).otherwise(
        F.xxhash64(F.lit(-1).cast("long"), spread(F.greatest("in_rest", F.lit(1))))
    )
    alone = F.when(F.col("in_comp") >= BLOCK, F.col("comp"))
    of_large = of_large.withColumns({"block": block, "alone": alone})
    blocks = of_large.select("key", "block", "alone").distinct()
    first = blocks.select("key", F.col("block").alias("x"), F.col("alone").alias("x_alone"))
    second = blocks.select("key", F.col("block").alias("y"), F.col("alone").alias("y_alone"))
    pairs = first.join(second, "key").filter(
        (F.col("x") <= F.col("y")) & ~(F.coalesce(F.col("x_alone") == F.col("y_alone"), F.lit(False)))
    )
    ends = pairs.select(
        "key", F.xxhash64("x", "y").alias("pair"),
        F.explode(
            F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("block"), F.lit(0).alias("side"))))
            .otherwise(F.array(
                F.struct(F.col("x").alias("block"), F.lit(-1).alias("side")),
                F.struct(F.col("y").alias("block"), F.lit(1).alias("side")),
            ))
        ).alias("e"),
    ).select("key", "pair", "e.block", "e.side")
    dealt = of_large.join(ends, ["key", "block"]).select(*rows.columns, "pair", "side")
    return small_rows.select(*rows.columns, "pair", "side").unionByName(dealt)


def _apart(members, points, comps, threshold: int, every: bool) -> DataFrame:
    """(a, b, cut): pairs that share a key, are in different components and may link."""
    held = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    held = materialize(held)
    mixed = held.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    held = materialize(held.join(mixed.select("key"), "key", "left_semi"))
    rows = _blocked(held).join(points.select("node", "n", "point"), "node")
    found = (
        rows.repartition(partitions(members.sparkSession), "key", "pair")
        .sortWithinPartitions("key", "pair", "side")
        .select("key", "pair", "side", "node", "n", "comp", "point")
        .mapInPandas(_apart_kernel(threshold, every), "a long, b long, cut boolean")
    )
    return materialize(found.groupBy("a", "b").agg(F.max("cut").alias("cut")))


def _components(links: DataFrame) -> DataFrame:
    edges = links.select(F.lit(0).alias("g"), F.col("a").alias("u"), F.col("b").alias("v"))
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = connected_components(nodes.withColumn("g", F.lit(0)), edges)
    return materialize(found.select("node", F.col("component").alias("comp")))


def _groups(docs: DataFrame, text: str, doc_id: str, threshold: int, size: int):
    """The rows' sets, and their classes of equal sets: digest, number of rows, the
    smallest id of the component, and `head` with the (doc_id, copy) of its first row.

    A class is a node of the graph, whatever ids its rows have.
    """
    sets = materialize(shingle_sets(docs, text, doc_id, threshold, size))
    total = sets.count()
    classes = materialize(
        sets.filter("n > 0").groupBy(*DIGEST)
        .agg(F.min(F.struct("doc_id", "copy")).alias("first"), F.count("*").alias("rows"))
        .select(*DIGEST, "first.doc_id", "first.copy", "rows", F.monotonically_increasing_id().alias("node"))
    )
    met = _meetings(sets)
    members = materialize(
        met.join(classes.select("d1", "node"), "d1").select("key", "node").distinct()
    )
    involved = classes.join(members.select("node").distinct(), "node", "left_semi")
    # One row of each class brings its text.
    texts = lookup(
        _texts(docs, text, doc_id), involved.select("doc_id", "copy", "rows", "node"),
        ["doc_id", "copy"], "rows", total,
    ).filter("node is not null")
    points = materialize(
        texts.select("node", "text").mapInPandas(
            _points_kernel(size), "node long, n long, point binary, shingles array<long>"
        ).dropDuplicates(["node"])
    )
    names = classes.select("d1", "node")
    chain = (
        met.filter("linked").select("before", "d1").distinct()
        .join(names.withColumnRenamed("node", "b"), "d1")
        .join(names.select(F.col("d1").alias("before"), F.col("node").alias("a")), "before")
    )
    chain = materialize(
        chain.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a <> b").distinct()
    )
    tested, links = chain, materialize(_verified(chain, points, threshold))
    every = False
    while True:
        comps = _components(links)
        found = _apart(members, points, comps, threshold, every)
        fresh = materialize(found.select("a", "b").join(tested, ["a", "b"], "left_anti"))
        more = materialize(_verified(fresh, points, threshold))
        grown = more.count() > 0
        if grown:
            links = links.unionByName(more)
        if found.filter("cut").isEmpty():
            break
        tested, every = tested.unionByName(fresh), not grown
    if grown:
        comps = _components(links)
    first = F.struct("doc_id", "d1", "d2", "copy")
    heads = materialize(
        classes.join(comps, "node").groupBy("comp").agg(F.min(first).alias("least"), F.count("*").alias("nodes"))
    )
    linked = lookup(comps, heads, ["comp"], "nodes", comps.count())
    least = F.coalesce("least", first)
    named = classes.join(linked.select("node", "least"), "node", "left").select(
        *DIGEST, "rows", least["doc_id"].alias("comp"),
        F.when(least == first, F.struct("doc_id", "copy")).alias("head"),
    )
    return sets, materialize(named), total


def jaccard_components(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    threshold: int = THRESHOLD, size: int = SHINGLE,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when 100 * |A and B| >= threshold * |A or B| over their sets
    of `size`-word shingles; the component is the smallest id reachable.  NULL
    and empty texts have an empty set and link with nothing.  Repeated rows come
    out as often as they went in.  A NULL id links like any other document; its
    component is the smallest id it reaches, or NULL.  Rows that share an id but
    not a text get the component of their own text.  Other columns are ignored.
    """
    sets, named, total = _groups(docs, text, doc_id, threshold, size)
    out = lookup(sets.select("doc_id", *DIGEST), named.drop("head"), DIGEST, "rows", total)
    known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    component = F.when(F.col("n") == 0, known).otherwise(F.when(F.col("comp") != NO_ID, F.col("comp")))
    return out.select(known.alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))


def first_of_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    threshold: int = THRESHOLD, size: int = SHINGLE,
) -> DataFrame:
    """The rows of `docs` that stay: of each group of linked documents the one with
    the smallest id, once.  NULL ids come last; of several texts under that id, or
    without any id in the group, the smallest digest stays.  Documents without a
    set stay, repeated ones once.
    """
    sets, named, _ = _groups(docs, text, doc_id, threshold, size)
    alone = sets.filter("n = 0").select("doc_id", "copy").distinct()
    heads = named.filter("head is not null").select("head.*").unionByName(alone)
    # the input goes along as one column, so that no name of it can meet one made here
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("in"),
        _number(doc_id).alias("doc_id"), _copy(text).alias("copy"),
    )
    kept = marked.join(heads, ["doc_id", "copy"], "left_semi")
    equal = W.partitionBy("doc_id", "copy").orderBy("copy")
    first = kept.withColumn("n", F.row_number().over(equal)).filter("n = 1")
    return first.select(*[F.col("in")[c].alias(c) for c in docs.columns])
