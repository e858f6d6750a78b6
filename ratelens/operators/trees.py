"""Extremely randomised regression trees as tables.

A node draws one cut for each feature between the feature's bounds in that node, and takes the cut that leaves least
variance. Nodes with many rows are grown level by level: one pass for the bounds, one for the sums on both sides of
every cut, all trees together, in which each task sends one row for each node. A node with few rows is finished by one
task, whose rows come as blocks of bytes. Cuts depend on the seed, the tree, the node and the feature alone and sums are
whole numbers, so any partitioning and any rerun grows the same trees.

Node 1 is a tree's root; the children of node i are 2 i (at most the cut) and 2 i + 1.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.hashing import HASH_SPAN, md5_words, seeded_hash
from ratelens.session import stored

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 1e-6  # labels are whole numbers of it
LOCAL_ROWS = 131_072
PART_ROWS = 16_384  # rows of a task that reads the encoded rows, at least
DEALT_BYTES = 16 << 30  # so many bytes of rows are dealt to nodes by one job
PASS_BYTES = 256 << 20  # of one task's sums
SENT_NODES = 1_024  # so many nodes at most, with a cut for each feature, are sent to all executors
_LAST = 1 << 60  # nodes from here on have no children: their numbers would leave a long

_SPLIT = "tree int, node bigint, feature int, cut double"
_SUBTREE = "tree int, node bigint, depth int, features array<int>, cuts array<double>, lefts array<int>, n array<bigint>, sums array<bigint>"


@dataclass(frozen=True)
class Forest:
    """``splits(tree, node, feature, cut)`` of the levels grown together, and ``subtrees`` below them, one row each.

    A subtree's arrays hold its nodes: feature, cut, place of the left child (the right one follows; -1: a leaf),
    rows, and the sum of their labels in units.
    """

    splits: DataFrame
    subtrees: DataFrame
    trees: int
    levels: int


def _drawn(seed: int) -> Column:
    key = F.concat_ws(":", "tree", "node", "feature")
    return seeded_hash(key, seed) / F.lit(float(HASH_SPAN))


def _gain(n: Column, total: Column, n_left: Column, left: Column) -> Column:
    """What a cut adds to the sum of squares that the nodes' means explain, but for a term that all cuts share."""
    right, a, b = (total - left).cast("double"), left.cast("double"), n - n_left
    return a * a / n_left.cast("double") + right * right / b.cast("double")


def feature_bounds(placed: DataFrame) -> DataFrame:
    """``(tree, node, feature, low, high)`` of ``placed(tree, node, x, y)``; each task sends one row for each of them."""
    values = placed.select("tree", "node", F.posexplode("x").alias("feature", "value"))
    return values.groupBy("tree", "node", "feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))


def _beside_nodes(placed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of ``placed`` beside the row of their node in ``nodes``, a stored table.

    Spark would judge ``placed`` by its compressed size, which is a small part of that of its arrays, and send it to
    all executors. A few nodes are sent instead; with many, the rows are spread over their nodes.
    """
    few = nodes.count() <= SENT_NODES
    return placed.join(F.broadcast(nodes) if few else nodes.hint("merge"), ["tree", "node"])


def best_splits(placed: DataFrame, seed: int) -> DataFrame:
    """The best of the drawn cuts of each node: ``(tree, node, feature, cut, low, high, n, n_left, gain)``.

    Features with one value in a node have no cut there, and a node without any cut has no row. Equal gains go to the
    feature with the smaller number.
    """
    cuts = feature_bounds(placed).filter("low < high")
    cuts = cuts.withColumn("cut", F.col("low") + (F.col("high") - F.col("low")) * _drawn(seed)).filter("cut < high")
    # As many cuts in a row as there are features.
    per_node = cuts.groupBy("tree", "node").agg(F.collect_list(F.struct("feature", "cut", "low", "high")).alias("cuts"))
    tried = _beside_nodes(placed, stored(per_node, "cuts")).select("tree", "node", "x", "y", F.inline("cuts"))
    low_side = F.get("x", F.col("feature")) <= F.col("cut")
    sums = tried.groupBy("tree", "node", "feature", "cut", "low", "high").agg(
        F.count("*").alias("n"),
        F.sum("y").alias("total"),
        F.count_if(low_side).alias("n_left"),
        F.coalesce(F.sum(F.when(low_side, F.col("y"))), F.lit(0)).alias("left"),
    )
    sums = sums.filter("n_left > 0 AND n_left < n")
    gain = _gain(F.col("n"), F.col("total"), F.col("n_left"), F.col("left"))
    order = F.struct(gain.alias("gain"), (-F.col("feature")).alias("first"))
    row = F.struct("feature", "cut", "low", "high", "n", "n_left", gain.alias("gain"))
    return sums.groupBy("tree", "node").agg(F.max_by(row, order).alias("best")).select("tree", "node", "best.*")


def children(placed: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows of split nodes, placed in the child on their side of the cut; ``splits`` is a stored table."""
    joined = _beside_nodes(placed, splits.select("tree", "node", "feature", "cut"))
    side = F.when(F.get("x", F.col("feature")) <= F.col("cut"), 0).otherwise(1)
    return joined.select("tree", (F.col("node") * 2 + side).alias("node"), "x", "y")


def in_units(label: Column, unit: float = UNIT) -> Column:
    return F.round(label.cast("double") / F.lit(unit)).cast("bigint")


def place(rows: DataFrame, trees: int) -> DataFrame:
    """``rows(x, y)`` at the root of every tree."""
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    return rows.select(every, F.lit(1).cast("bigint").alias("node"), "x", "y")


def _draw(seed: int, tree: int, node: int, feature: int) -> float:
    return int(hashlib.md5(f"{seed}:{tree}:{node}:{feature}".encode()).hexdigest()[:8], 16) / HASH_SPAN


def _digits(numbers: np.ndarray, length: int) -> np.ndarray:
    out = np.empty((len(numbers), length), np.uint8)
    for place in range(length - 1, -1, -1):
        numbers, digit = np.divmod(numbers, 10)
        out[:, place] = digit + ord("0")
    return out


def draw_all(seed: int, tree: int, nodes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """``_draw`` of many nodes and features of a tree at once."""
    out, head = np.empty(len(nodes)), np.frombuffer(f"{seed}:{tree}:".encode(), np.uint8)
    powers = 10 ** np.arange(1, 19, dtype=np.int64)
    lengths = (np.searchsorted(powers, nodes, side="right") + 1) * 32 + np.searchsorted(powers, features, side="right") + 1
    for both in np.unique(lengths).tolist():
        n, f = divmod(both, 32)
        own = np.nonzero(lengths == both)[0]
        size = len(head) + n + 1 + f
        if size > 55:  # more than one block
            out[own] = [_draw(seed, tree, int(nodes[k]), int(features[k])) for k in own]
            continue
        for first in range(0, len(own), 8192):
            some = own[first : first + 8192]
            message = np.zeros((len(some), 64), np.uint8)
            message[:, : len(head)] = head
            message[:, len(head) : len(head) + n] = _digits(nodes[some], n)
            message[:, len(head) + n] = ord(":")
            message[:, size - f : size] = _digits(features[some], f)
            message[:, size] = 0x80
            message[:, 56:58] = np.array([8 * size], "<u2").view(np.uint8)
            out[some] = md5_words(message)[0] / HASH_SPAN
    return out


def draws(
    seed: int, tree: int, nodes: np.ndarray, counts: np.ndarray, low: np.ndarray, high: np.ndarray, numbers: np.ndarray
) -> np.ndarray:
    """Cuts of each feature (rows, ``numbers``) in each node (columns) by ``best_splits``' rule; infinite where there is none.

    In a node of two rows all cuts part them alike, so that the first feature's is the best one.
    """
    cuts, varying = np.full(low.shape, np.inf), low < high
    wanted = varying.copy()
    two = np.nonzero((counts == 2) & varying.any(axis=0))[0]
    first = varying[:, two].argmax(axis=0) if len(two) else two
    wanted[:, two] = False
    wanted[first, two] = True
    features, at = np.nonzero(wanted)
    cut = low[features, at] + (high[features, at] - low[features, at]) * draw_all(seed, tree, nodes[at], numbers[features])
    cuts[features, at] = np.where(cut < high[features, at], cut, np.inf)
    for a in two[~np.isfinite(cuts[first, two])].tolist():  # hardly ever: the cut was rounded up to the bound
        for f in np.nonzero(varying[:, a])[0].tolist():
            cut = low[f, a] + (high[f, a] - low[f, a]) * _draw(seed, tree, int(nodes[a]), int(numbers[f]))
            if cut < high[f, a]:
                cuts[f, a] = cut
                break
    return cuts


class Subtree:
    """A subtree's nodes as they are found, level by level."""

    def __init__(self, root: int, n: int, total: int):
        self.root, self.depth, self.size = root, 0, 1
        self.features, self.cuts, self.lefts = [np.array([-1])], [np.array([0.0])], [np.array([-1])]
        self.n, self.sums = [np.array([n], np.int64)], [np.array([total], np.int64)]
        self._places = np.array([0])

    def split(self, inner: np.ndarray, features: np.ndarray, cuts: np.ndarray, n: np.ndarray, sums: np.ndarray) -> None:
        """The last level's ``inner`` nodes get two children each, left and right, of ``n`` rows with labels ``sums``."""
        places = self._places[inner] - (self.size - len(self.features[-1]))
        self.features[-1][places], self.cuts[-1][places] = features, cuts
        self.lefts[-1][places] = self.size + 2 * np.arange(len(inner))
        new = 2 * len(inner)
        self._places = self.size + np.arange(new)
        self.size, self.depth = self.size + new, self.depth + 1
        self.features.append(np.full(new, -1)), self.cuts.append(np.zeros(new)), self.lefts.append(np.full(new, -1))
        self.n.append(n), self.sums.append(sums)

    def narrow(self, kept: np.ndarray) -> None:
        self._places = self._places[kept]

    def table(self, tree: int) -> pa.Table:
        def whole(parts: list[np.ndarray], kind) -> pa.Array:
            values = pa.array(np.concatenate(parts), kind)
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        columns = {
            "tree": pa.array([tree], pa.int32()), "node": pa.array([self.root], pa.int64()), "depth": pa.array([self.depth], pa.int32()),
            "features": whole(self.features, pa.int32()), "cuts": whole(self.cuts, pa.float64()), "lefts": whole(self.lefts, pa.int32()),
            "n": whole(self.n, pa.int64()), "sums": whole(self.sums, pa.int64()),
        }
        return pa.table(columns)


@dataclass(frozen=True)
class Layout:
    """Places of features in packed rows: ``flags``, which are 0 or 1 in all rows, take a bit each, the others 8 bytes."""

    others: np.ndarray
    flags: np.ndarray

    @property
    def size(self) -> int:
        return 8 * len(self.others) + -(-len(self.flags) // 8)

    @classmethod
    def of(cls, flag: np.ndarray) -> Layout:
        return cls(np.nonzero(~flag)[0], np.nonzero(flag)[0])

    def pack(self, x: np.ndarray) -> np.ndarray:
        wide = np.ascontiguousarray(x[:, self.others], dtype=np.float64).view(np.uint8)
        return np.concatenate([wide, np.packbits(x[:, self.flags] != 0, axis=1)], axis=1)

    def parts(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the other features, and bits of the flags."""
        end = 8 * len(self.others)
        return np.ascontiguousarray(packed[:, :end]).view(np.float64), np.unpackbits(packed[:, end:], axis=1, count=len(self.flags))

    def whole(self, packed: np.ndarray) -> np.ndarray:
        x = np.empty((len(packed), len(self.others) + len(self.flags)))
        x[:, self.others], x[:, self.flags] = self.parts(packed)
        return x


def are_flags(x: np.ndarray) -> np.ndarray:
    return ((x == 0) | (x == 1)).all(axis=0)


def layout_of(table: DataFrame, width: int) -> Layout:
    """The layout of all rows of ``table(x)``, an encoded table."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flag = are_flags(blocks(batch.column("x"), np.float64, width))
                yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array(flag)], ["feature", "flag"])

    tested = table.select("x").mapInArrow(test, "feature int, flag boolean").groupBy("feature").agg(F.bool_and("flag"))
    flag = np.zeros(width, bool)
    for feature, told in tested.collect():  # one row a feature
        flag[feature] = told
    return Layout.of(flag)


def packed(table: DataFrame, layout: Layout) -> DataFrame:
    width = len(layout.others) + len(layout.flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = layout.pack(blocks(batch.column("x"), np.float64, width))
                yield pa.record_batch([pa.array([row.tobytes() for row in rows], pa.binary()), batch.column("y")], ["x", "y"])

    return stored(table.mapInArrow(run, "x binary, y bigint"), "packed")


class Ones:
    """The rows in which each flag is 1, ordered by node, flag and row while nodes are divided.

    Rows have few flags that are 1, so that this takes less than all flags of all rows do.
    """

    def __init__(self, bits: np.ndarray):
        self.flags, self.rows = np.nonzero(np.ascontiguousarray(bits.T))
        self.nodes = np.zeros(len(self.rows), np.int64)

    def keep(self, kept: np.ndarray) -> None:
        """Those in ``kept`` nodes alone, which are numbered anew."""
        own, rank = kept[self.nodes], np.cumsum(kept) - 1
        self.flags, self.rows, self.nodes = self.flags[own], self.rows[own], rank[self.nodes[own]]

    def groups(self, counts: np.ndarray) -> np.ndarray:
        """Where each node's flag begins. A flag that all rows of its node have is left out, as it has no cut further down."""
        while True:
            new = np.ones(len(self.rows), bool)
            new[1:] = (self.nodes[1:] != self.nodes[:-1]) | (self.flags[1:] != self.flags[:-1])
            first = np.nonzero(new)[0]
            sizes = np.diff(np.append(first, len(self.rows)))
            varying = sizes < counts[self.nodes[first]]
            if varying.all():
                return first
            own = np.repeat(varying, sizes)
            self.flags, self.rows, self.nodes = self.flags[own], self.rows[own], self.nodes[own]

    def divide(self, side: np.ndarray, nodes: int) -> None:
        """By ``side`` of each row, into nodes 2 i and 2 i + 1."""
        right = side[self.rows]
        child = 2 * self.nodes + right
        sizes = np.bincount(child, minlength=2 * nodes)
        starts = np.cumsum(sizes) - sizes
        order = np.empty(len(child), np.int64)
        for value in (0, 1):
            own = np.nonzero(right == value)[0]
            before = np.cumsum(sizes[value::2]) - sizes[value::2]
            node = self.nodes[own]
            order[np.arange(len(own)) - before[node] + starts[2 * node + value]] = own
        self.flags, self.rows, self.nodes = self.flags[order], self.rows[order], child[order]


def best_of_groups(gain: np.ndarray, node: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest gain of each node's groups and the first group that has it; minus infinity and -1 without any."""
    tops, places = np.full(nodes, -np.inf), np.full(nodes, -1)
    if len(gain):
        starts = np.nonzero(np.concatenate([[True], node[1:] != node[:-1]]))[0]
        tops[node[starts]] = np.maximum.reduceat(gain, starts)
        at = np.nonzero((gain == tops[node]) & (gain > -np.inf))[0]
        places[node[at][::-1]] = at[::-1]
    return tops, places


def finish(values: np.ndarray, bits: np.ndarray, layout: Layout, y: np.ndarray, tree: int, root: int, seed: int, least: int) -> pa.Table:
    """The subtree of a node with few rows, by the rules of ``best_splits``, level by level.

    Whatever is drawn, a cut between 0 and 1 parts the rows alike, so that a flag's cut is drawn only where it is the best.
    """
    columns, others, flags = np.ascontiguousarray(values.T), layout.others, layout.flags
    place = np.empty(len(others) + len(flags), np.int64)
    place[others], place[flags] = np.arange(len(others)), np.arange(len(flags))
    is_flag = np.zeros(len(place), bool)
    is_flag[flags] = True
    out, ones = Subtree(root, len(y), int(y.sum())), Ones(bits)
    rows, nodes, counts = np.arange(len(y)), np.array([root], np.int64), np.array([len(y)])
    totals = np.array([int(y.sum())], np.int64)
    varying = np.ones((len(columns), 1), bool)  # features that may have a cut: those that have one in the parent
    while len(nodes):
        starts, labels = np.cumsum(counts) - counts, y[rows]
        mixed = np.minimum.reduceat(labels, starts) < np.maximum.reduceat(labels, starts)
        able = (counts >= least) & (nodes < _LAST) & mixed
        rows = rows[np.repeat(able, counts)]
        nodes, counts, totals, varying = nodes[able], counts[able], totals[able], varying[:, able]
        out.narrow(able)
        ones.keep(able)
        if not len(nodes):
            break
        owner = np.repeat(np.arange(len(nodes)), counts)
        low, high = np.zeros(varying.shape), np.zeros(varying.shape)
        held = []
        for f, column in enumerate(columns):
            some = varying[f]
            held.append(column[rows if some.all() else rows[some[owner]]])
            if some.any():
                starts = np.cumsum(counts[some]) - counts[some]
                low[f, some], high[f, some] = np.minimum.reduceat(held[f], starts), np.maximum.reduceat(held[f], starts)
        before, varying = varying, low < high
        cuts = draws(seed, tree, nodes, counts, low, high, others)
        gains, features = np.full(len(nodes), -np.inf), np.full(len(nodes), -1)
        for f, some in enumerate(np.isfinite(cuts)):
            if not some.any():
                continue
            n, own, values = counts[some], rows, held[f]
            if not some.all():
                chosen = some[owner]
                own, values = rows[chosen], values[chosen if before[f].all() else chosen[before[f][owner]]]
            starts, total = np.cumsum(n) - n, totals[some]
            side = values <= np.repeat(cuts[f, some], n)
            n_left = np.add.reduceat(side.astype(np.int64), starts)
            left = np.add.reduceat(np.where(side, y[own], 0), starts)
            a, b = left.astype(float), (total - left).astype(float)
            gain = np.full(len(nodes), -np.inf)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain[some] = np.where((n_left > 0) & (n_left < n), a * a / n_left + b * b / (n - n_left), -np.inf)
            better = gain > gains
            gains[better], features[better] = gain[better], others[f]
        cut = cuts[np.where(features >= 0, place[features], 0), np.arange(len(nodes))] if len(others) else np.zeros(len(nodes))
        first = ones.groups(counts)
        if len(first):
            node, size = ones.nodes[first], np.diff(np.append(first, len(ones.rows)))
            high_sum = np.add.reduceat(y[ones.rows], first)
            a, b = (totals[node] - high_sum).astype(float), high_sum.astype(float)
            gain, group = best_of_groups(a * a / (counts[node] - size) + b * b / size, node, len(nodes))
            found = np.where(group >= 0, flags[ones.flags[first]][group], -1)
            better = (gain > gains) | ((gain == gains) & (found >= 0) & (found < features))
            features[better] = found[better]
            cut[better] = draw_all(seed, tree, nodes[better], found[better])
        inner = np.nonzero(features >= 0)[0]
        if not len(inner):
            break
        split = features >= 0
        kept = split[owner]
        rows, owner = rows[kept], owner[kept]
        ones.keep(split)
        chosen = features[owner]
        high_side, by_flag = np.empty(len(rows), bool), is_flag[chosen]
        here = np.nonzero(by_flag)[0]
        high_side[here] = bits[rows[here], place[chosen[here]]] > 0
        here = np.nonzero(~by_flag)[0]
        high_side[here] = columns[place[chosen[here]], rows[here]] > cut[owner[here]]
        side = np.zeros(len(y), bool)
        side[rows] = high_side
        ones.divide(side, len(inner))
        child = 2 * (np.cumsum(split) - 1)[owner] + high_side
        order = np.argsort(child, kind="stable")
        rows, counts = rows[order], np.bincount(child, minlength=2 * len(inner))
        totals = np.add.reduceat(y[rows], np.cumsum(counts) - counts)
        out.split(inner, features[inner], cut[inner], counts, totals)
        varying = np.repeat(varying[:, inner], 2, axis=1)
        nodes = np.stack([2 * nodes[inner], 2 * nodes[inner] + 1], axis=1).ravel()
    return out.table(tree)


#: Splits of one tree's levels grown together: node numbers in order, and their features and cuts.
Top = tuple[np.ndarray, np.ndarray, np.ndarray]


def top_of(splits: list[tuple[int, int, float]]) -> Top:
    nodes, features, cuts = zip(*sorted(splits)) if splits else ((), (), ())
    return np.array(nodes, np.int64), np.array(features, np.int64), np.array(cuts, float)


def descend(x: np.ndarray, top: Top, rows: np.ndarray) -> np.ndarray:
    """The node below the top in which each of the ``rows`` of ``x`` ends."""
    nodes, features, cuts = top
    at = np.ones(len(rows), np.int64)
    live = np.arange(len(rows)) if len(nodes) else np.array([], np.int64)
    while len(live):
        here = np.minimum(np.searchsorted(nodes, at[live]), len(nodes) - 1)
        inside = nodes[here] == at[live]
        live, here = live[inside], here[inside]
        at[live] = 2 * at[live] + (x[rows[live], features[here]] > cuts[here])
    return at


def blocks(values: pa.Array, dtype, width: int) -> np.ndarray:
    """Rows of equally long byte strings, as an array."""
    joined = b"".join(values.to_pylist())
    return np.frombuffer(joined, dtype).reshape(-1, width)


def encode(rows: DataFrame) -> DataFrame:
    """``(x, y)`` with the array's doubles as bytes, stored in parts of a bounded number of rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                packed = [row.tobytes() for row in np.ascontiguousarray(values, dtype=np.float64)]
                yield pa.record_batch([pa.array(packed, pa.binary()), batch.column("y")], ["x", "y"])

    packed = rows.select("x", F.col("y").cast("bigint").alias("y")).mapInArrow(pack, "x binary, y bigint")
    return in_parts(stored(packed, "encoded"), "encoded-parts")


def in_parts(table: DataFrame, label: str) -> DataFrame:
    return stored(table.repartition(max(1, -(-table.count() // PART_ROWS))), label)


_BLOCK = "tree int, node bigint, x binary, y binary, w binary"


def deal(
    table: DataFrame, tops: list[Top], chosen: list[int], ends: set, width: int, bag: Callable | None = None,
    whole: Callable[[np.ndarray], np.ndarray] = lambda x: x,
) -> DataFrame:
    """Blocks of the rows of ``table(x, y, ...)`` that end in each node below the ``chosen`` trees' tops, but for ``ends``.

    ``bag(tree, batch)`` gives the rows' weights in a tree; those of weight 0 are left out. ``whole`` gives the features
    of rows of ``width`` bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            every, labels = blocks(batch.column("x"), np.uint8, width), batch.column("y").to_numpy()
            x = whole(every)
            for tree in chosen:
                weights = bag(tree, batch) if bag else None
                drawn = np.nonzero(weights)[0] if bag else np.arange(len(labels))
                at = descend(x, tops[tree], drawn)
                order = np.argsort(at, kind="stable")
                at, drawn = at[order], drawn[order]
                nodes, starts = np.unique(at, return_index=True)
                parts = [(n, own) for n, own in zip(nodes.tolist(), np.split(drawn, starts[1:])) if (tree, n) not in ends and len(own)]
                if parts:
                    yield pa.record_batch(
                        [
                            pa.array([tree] * len(parts), pa.int32()),
                            pa.array([n for n, _ in parts], pa.int64()),
                            pa.array([every[own].tobytes() for _, own in parts], pa.binary()),
                            pa.array([labels[own].tobytes() for _, own in parts], pa.binary()),
                            pa.array([weights[own].tobytes() if bag else b"" for _, own in parts], pa.binary()),
                        ],
                        ["tree", "node", "x", "y", "w"],
                    )

    return table.mapInArrow(run, _BLOCK)


def finish_dealt(
    table: DataFrame, tops: list[Top], leaves: list[tuple], width: int, rows: int,
    local: Callable[[np.ndarray, np.ndarray, np.ndarray, int, int], pa.Table], bag: Callable | None = None,
    whole: Callable[[np.ndarray], np.ndarray] = lambda x: x,
) -> DataFrame:
    """Subtrees below the tops, stored; ``leaves`` are ``(tree, node, n, total)`` that end there.

    Trees are dealt by a bounded number of bytes at a time, as each has its own copy of the rows.
    """
    ends, spark = {(tree, node) for tree, node, _, _ in leaves}, table.sparkSession
    at_once = max(1, int(DEALT_BYTES // max(1, rows * (width + 16))))

    def one(group: pa.Table) -> pa.Table:
        x, y = blocks(group.column("x"), np.uint8, width), blocks(group.column("y"), np.int64, 1)[:, 0]
        weights = blocks(group.column("w"), np.int64, 1)[:, 0]
        return local(x, y, weights, group.column("tree")[0].as_py(), group.column("node")[0].as_py())

    done = []
    for first in range(0, len(tops), at_once):
        chosen = list(range(first, min(first + at_once, len(tops))))
        # Tasks are as many as trees or nodes of the wanted size: their work, not their bytes, is what counts.
        tasks = max(2 * len(chosen), -(-rows * len(chosen) // LOCAL_ROWS))
        dealt = deal(table, tops, chosen, ends, width, bag, whole).repartition(tasks, "tree", "node")
        done.append(stored(dealt.groupBy("tree", "node").applyInArrow(one, _SUBTREE), "forest-subtrees"))
    flat = [(tree, node, 0, [-1], [0.0], [-1], [n], [total]) for tree, node, n, total in leaves]
    out = spark.createDataFrame(flat, _SUBTREE)
    for some in done:
        out = out.union(some)
    return out


def passes(nodes: list[tuple[int, int]], node_bytes: int) -> Iterator[list[tuple[int, int]]]:
    """The nodes in groups whose sums fit a task."""
    most = max(1, PASS_BYTES // node_bytes)
    for first in range(0, len(nodes), most):
        yield nodes[first : first + most]


def add_up(
    table: DataFrame, tops: list[Top], nodes: list[tuple[int, int]], width: int, zero: Callable[[], np.ndarray],
    add: Callable, merge: Callable[[list[np.ndarray]], np.ndarray], bag: Callable | None = None,
    whole: Callable[[np.ndarray], np.ndarray] = lambda x: x,
) -> DataFrame:
    """``(tree, node, sums)``: ``add(sums, tree, node, x, y, w)`` over the rows of each node, one row a node and task merged."""
    by_tree: dict[int, set[int]] = {}
    for tree, node in nodes:
        by_tree.setdefault(tree, set()).add(node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            every, labels = blocks(batch.column("x"), np.uint8, width), batch.column("y").to_numpy()
            x = whole(every)
            for tree, wanted in by_tree.items():
                weights = bag(tree, batch) if bag else np.ones(len(labels), np.int64)
                drawn = np.nonzero(weights)[0]
                at = descend(x, tops[tree], drawn)
                order = np.argsort(at, kind="stable")
                numbers, starts = np.unique(at[order], return_index=True)
                for node, own in zip(numbers.tolist(), np.split(drawn[order], starts[1:])):
                    if node in wanted and len(own):
                        sums = found.setdefault((tree, node), zero())
                        add(sums, tree, node, every[own], labels[own], weights[own])
        for (tree, node), sums in found.items():
            yield pa.record_batch(
                [pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array([sums.tobytes()], pa.binary())], ["tree", "node", "sums"]
            )

    def one(group: pa.Table) -> pa.Table:
        merged = merge([np.frombuffer(v, np.float64) for v in group.column("sums").to_pylist()])
        return group.slice(0, 1).set_column(2, "sums", pa.array([merged.tobytes()], pa.binary()))

    kind = "tree int, node bigint, sums binary"
    return table.mapInArrow(run, kind).groupBy("tree", "node").applyInArrow(one, kind)


def _top_level(table: DataFrame, tops: list[Top], nodes: list[tuple[int, int]], layout: Layout, seed: int) -> list[tuple]:
    """``(tree, node, feature, cut, n, total, n_left, left)`` of the nodes; feature -1: a leaf. One row for each node."""
    wide, flags = len(layout.others), len(layout.flags)
    width = wide + flags

    # Bounds of the other features and the label, rows and labels in all, and of those in which a flag is 1.
    def widen(sums, tree, node, x, y, w):
        values, bits = layout.parts(x)
        low, high = sums[:wide], sums[wide : 2 * wide]
        np.minimum(low, values.min(axis=0), out=low), np.maximum(high, values.max(axis=0), out=high)
        more = sums[2 * wide :]
        more[0], more[1] = min(more[0], y.min()), max(more[1], y.max())
        more[2] += len(y)
        more[3] += y.sum()
        rows, own = np.nonzero(bits)
        more[4 : 4 + flags] += np.bincount(own, minlength=flags)
        more[4 + flags :] += np.bincount(own, y[rows].astype(float), minlength=flags)

    def widest(parts):
        both = np.stack(parts)
        out = both.sum(axis=0)
        low, high = np.r_[:wide, 2 * wide], np.r_[wide : 2 * wide, 2 * wide + 1]
        out[low], out[high] = both[:, low].min(axis=0), both[:, high].max(axis=0)
        return out

    def none():
        return np.concatenate([np.full(wide, np.inf), np.full(wide, -np.inf), [np.inf, -np.inf], np.zeros(2 + 2 * flags)])

    found = []
    for some in passes(nodes, 48 * width):
        bounds = add_up(table, tops, some, layout.size, none, widen, widest, whole=layout.whole).collect()
        cuts, known = {}, {}
        for tree, node, data in bounds:
            ends = np.frombuffer(data)
            low, high = ends[:wide, None], ends[wide : 2 * wide, None]
            cuts[tree, node] = draws(seed, tree, np.array([node]), np.array([-1]), low, high, layout.others)[:, 0]
            known[tree, node] = ends[2 * wide :]

        def count(sums, tree, node, x, y, w, cuts=cuts):
            side = layout.parts(x)[0] <= cuts[tree, node]
            sums[:wide] += side.sum(axis=0)
            sums[wide:] += y.astype(float) @ side

        sums = add_up(
            table, tops, some, layout.size, lambda: np.zeros(2 * wide), count, lambda parts: np.sum(parts, axis=0), whole=layout.whole
        )
        for tree, node, data in sums.collect():
            got, (least, most, n, total), ones = np.frombuffer(data), known[tree, node][:4], known[tree, node][4:]
            cut, n_left, left = np.zeros(width), np.zeros(width), np.zeros(width)
            cut[layout.others], n_left[layout.others], left[layout.others] = cuts[tree, node], got[:wide], got[wide:]
            n_left[layout.flags], left[layout.flags] = n - ones[:flags], total - ones[flags:]
            good = np.isfinite(cut) & (n_left > 0) & (n_left < n) & (least < most)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(good, left * left / n_left + (total - left) ** 2 / (n - n_left), -np.inf)
            best = int(gain.argmax())
            feature = best if good[best] else -1
            where = _draw(seed, tree, node, best) if best in layout.flags else float(cut[best])
            found.append((tree, node, feature, where, int(n), int(total), int(n_left[best]), int(left[best])))
    return found


def grow_top(
    trees: int, rows: int, local_rows: int, levels: int, split: Callable[[list[Top], list[tuple[int, int]]], list[tuple]]
) -> tuple[list[Top], list[tuple], int]:
    """Tops of all trees, the leaves among their ends, and the number of levels.

    ``split(tops, nodes)`` gives nodes' splits as ``_top_level`` does. There are fewer nodes than trees times rows by
    ``local_rows`` on each level, of which the driver holds the splits alone.
    """
    splits: list[list[tuple]] = [[] for _ in range(trees)]
    tops, leaves, level = [top_of([]) for _ in range(trees)], [], 0
    nodes = [(tree, 1) for tree in range(trees)] if rows > local_rows else []
    while nodes:
        new = []
        for tree, node, feature, cut, n, total, n_left, left in split(tops, nodes):
            if feature < 0 or level >= levels:
                leaves.append((tree, node, n, total))
                continue
            splits[tree].append((node, feature, cut))
            new += [(tree, 2 * node + side) for side, size in enumerate((n_left, n - n_left)) if size > local_rows]
        tops = [top_of(own) for own in splits]
        nodes, level = new, level + 1
    return tops, leaves, max((int(top[0].max()).bit_length() for top in tops if len(top[0])), default=0)


def grow(
    rows: DataFrame, trees: int = 100, seed: int = 42, least: int = 2, local_rows: int = LOCAL_ROWS, levels: int = 60
) -> Forest:
    """Trees over all ``rows(x, y)``: ``x`` an array of doubles without NULL, ``y`` whole numbers (``in_units``).

    Every tree sees all rows. A node with fewer than ``least`` rows, one label or no cut is a leaf; there is no other
    limit of depth. Nodes with more than ``local_rows`` rows are split by passes over all of them; beyond ``levels``
    levels of these they are leaves.
    """
    table = encode(rows)
    n, first = table.count(), table.first()
    width = len(first["x"]) // 8 if first else 1
    layout = layout_of(table, width)
    table = packed(table, layout)
    tops, leaves, deep = grow_top(trees, n, local_rows, levels, lambda tops, nodes: _top_level(table, tops, nodes, layout, seed))
    local = lambda x, y, w, tree, node: finish(*layout.parts(x), layout, y, tree, node, seed, least)
    subtrees = finish_dealt(table, tops, leaves, layout.size, n, local, whole=layout.whole)
    return as_forest(table, tops, subtrees, deep)


def as_forest(table: DataFrame, tops: list[Top], subtrees: DataFrame, levels: int) -> Forest:
    flat = [
        (tree, node, feature, cut)
        for tree, top in enumerate(tops)
        for node, feature, cut in zip(*(part.tolist() for part in top))
    ]
    return Forest(table.sparkSession.createDataFrame(flat, _SPLIT), subtrees, len(tops), levels)


def _leaves(x: np.ndarray, features: np.ndarray, cuts: np.ndarray, lefts: np.ndarray) -> np.ndarray:
    """The place of each row's leaf in a subtree."""
    at = np.zeros(len(x), np.int64)
    live = np.arange(len(x))
    while True:
        live = live[lefts[at[live]] >= 0]
        if not len(live):
            return at
        here = at[live]
        at[live] = lefts[here] + (x[live, features[here]] > cuts[here])


def predict(rows: DataFrame, forest: Forest, unit: float = UNIT) -> DataFrame:
    """``(id, prediction)`` of ``rows(id, x)``: the mean of the leaves' means; ``id`` is unique.

    Rows descend the levels grown together as they are read, and go to their subtrees in blocks of bytes. Subtrees are
    repeated for more rows than they were grown from, so that no group of rows is larger than those.
    """
    splits: list[list[tuple]] = [[] for _ in range(forest.trees)]
    for tree, node, feature, cut in forest.splits.collect():  # as bounded as the levels grown together
        splits[tree].append((node, feature, cut))
    tops = [top_of(own) for own in splits]
    grown = forest.subtrees.filter("tree = 0").agg(F.sum(F.get("n", F.lit(0)))).first()[0] or 1
    copies = max(1, -(-rows.count() // max(int(grown), LOCAL_ROWS)))
    trees = forest.trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            ids = batch.column("id").to_numpy()
            copy = int(ids[0]) * 2654435761 % (1 << 32) * copies >> 32
            flag = are_flags(x)
            every, told = Layout.of(flag).pack(x), np.packbits(flag).tobytes()
            for tree in range(trees):
                at = descend(x, tops[tree], np.arange(len(x)))
                order = np.argsort(at, kind="stable")
                nodes, starts = np.unique(at[order], return_index=True)
                parts = np.split(order, starts[1:])
                columns = [
                    pa.array([tree] * len(parts), pa.int32()), pa.array(nodes, pa.int64()), pa.array([copy] * len(parts), pa.int32()),
                    pa.array([ids[own].tobytes() for own in parts], pa.binary()),
                    pa.array([every[own].tobytes() for own in parts], pa.binary()),
                    pa.array([told] * len(parts), pa.binary()), pa.array([x.shape[1]] * len(parts), pa.int32()),
                ]
                yield pa.record_batch(columns, ["tree", "node", "copy", "ids", "x", "flags", "width"])

    def one(subtree: pa.Table, dealt: pa.Table) -> pa.Table:
        if not dealt.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "mean": pa.array([], pa.float64())})
        ids = blocks(dealt.column("ids"), np.int64, 1)[:, 0]
        parts = []  # batches may differ in the features that are 0 or 1
        for data, told, width in zip(*(dealt.column(c).to_pylist() for c in ("x", "flags", "width"))):
            layout = Layout.of(np.unpackbits(np.frombuffer(told, np.uint8), count=width).astype(bool))
            parts.append(layout.whole(np.frombuffer(data, np.uint8).reshape(-1, layout.size)))
        x = np.concatenate(parts)
        features, cuts, lefts, n, sums = (
            subtree.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("features", "cuts", "lefts", "n", "sums")
        )
        leaf = _leaves(x, features, cuts, lefts)
        return pa.table({"id": pa.array(ids), "mean": pa.array(sums[leaf] * unit / n[leaf])})

    dealt = rows.select(F.col("id").cast("bigint").alias("id"), "x").mapInArrow(
        run, "tree int, node bigint, copy int, ids binary, x binary, flags binary, width int"
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    subtrees = forest.subtrees.select("tree", "node", each, "features", "cuts", "lefts", "n", "sums")
    keys = ["tree", "node", "copy"]
    leaf = subtrees.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(one, "id bigint, mean double")
    # Whole numbers add up alike in any order.
    parts = leaf.select("id", F.round(F.col("mean") * F.lit(1e9)).cast("decimal(38,0)").alias("part"))
    return parts.groupBy("id").agg((F.sum("part").cast("double") / F.lit(1e9 * forest.trees)).alias("prediction"))


def importances(forest: Forest) -> DataFrame:
    """``(feature, splits, rows)``: how many nodes split on each feature, and how many rows these hold, over all trees.

    Nodes of the levels grown together hold what their subtrees hold.
    """
    inner = forest.subtrees.select(F.inline(F.arrays_zip("features", "n", "lefts"))).filter("lefts >= 0")
    inner = inner.select(F.col("features").alias("feature"), "n")
    held = forest.subtrees.select("tree", "node", F.get("n", F.lit(0)).alias("n"))
    if forest.levels:
        ups = F.explode(F.sequence(F.lit(1), F.lit(forest.levels))).alias("up")
        above = held.select("tree", "node", "n", ups).select("tree", F.expr("shiftright(node, up)").alias("node"), "n")
        above = above.groupBy("tree", "node").agg(F.sum("n").alias("n"))
        inner = inner.union(above.join(forest.splits, ["tree", "node"]).select("feature", "n"))
    return inner.groupBy("feature").agg(F.count("*").alias("splits"), F.sum("n").alias("rows"))
