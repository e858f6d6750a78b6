"""Bagged trees as tables: in every node the cut that leaves least variance, among a few cut points a feature.

In every tree a row counts as often as a Poisson number says, which is drawn from a hash of tree, features and label,
so that any partitioning and any rerun draws the same bags. Features are numbered bins between at most 31 cut points.
Nodes with many rows are split by passes over all rows, in which each task sends a histogram for each node; a node with
few rows is finished by one task, all its nodes of a level together. For labels 0 and 1 least variance is least Gini
impurity, and a leaf's mean is the share of class 1.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators.trees import (
    LOCAL_ROWS,
    Forest,
    Ones,
    Subtree,
    Top,
    add_up,
    as_forest,
    best_of_groups,
    blocks,
    encode,
    finish_dealt,
    grow_top,
    in_parts,
    passes,
)
from ratelens.session import stored

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
SUMMARY = 256  # values that stand for those of a batch of rows, of a feature with more of them


def _summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= SUMMARY:
        return found, counts
    at = ((np.arange(SUMMARY) + 0.5) * len(values) / SUMMARY).astype(int)
    return np.sort(values)[at], np.full(SUMMARY, len(values) / SUMMARY)


def _cut_points(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between all values, if they are few, else values at equal shares of the weight."""
    found, inverse = np.unique(values, return_inverse=True)
    if len(found) <= bins:
        return (found[:-1] + found[1:]) / 2
    share = np.cumsum(np.bincount(inverse, weights))
    return np.unique(found[np.searchsorted(share, share[-1] * np.arange(1, bins) / bins)])


def cut_points(table: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Cut points of every feature of ``table(x)``, an encoded table.

    They are exact for features of at most ``bins`` values. Others are summed up by batch of rows, which moves a cut
    point by less than a 256th of the rows.
    """

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [_summary(column) for column in blocks(batch.column("x"), np.float64, width).T]
                yield pa.record_batch(
                    [
                        pa.array(range(width), pa.int32()),
                        pa.array([values.tobytes() for values, _ in found], pa.binary()),
                        pa.array([weights.astype(np.float64).tobytes() for _, weights in found], pa.binary()),
                    ],
                    ["feature", "values", "weights"],
                )

    def merge(group: pa.Table) -> pa.Table:
        joined = (np.frombuffer(b"".join(group.column(c).to_pylist())) for c in ("values", "weights"))
        cuts = _cut_points(*joined, bins)
        return pa.table({"feature": group.column("feature").slice(0, 1), "cuts": pa.array([cuts.tobytes()], pa.binary())})

    sums = table.select("x").mapInArrow(sum_up, "feature int, values binary, weights binary")
    rows = sums.groupBy("feature").applyInArrow(merge, "feature int, cuts binary").collect()  # one row a feature
    found = {feature: np.frombuffer(cuts) for feature, cuts in rows}
    return [found.get(f, np.array([])) for f in range(width)]


def binned(table: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``(x, y, c, h)``: different rows of bins and label, how often they come, and their hash."""
    width = len(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = blocks(batch.column("x"), np.float64, width)
                bins = np.empty(x.shape, np.uint8)
                for f in range(width):
                    bins[:, f] = np.searchsorted(cuts[f], x[:, f])
                yield pa.record_batch([pa.array([row.tobytes() for row in bins], pa.binary()), batch.column("y")], ["x", "y"])

    rows = table.mapInArrow(place, "x binary, y bigint").groupBy("x", "y").agg(F.count("*").alias("c"))
    return in_parts(stored(rows.withColumn("h", F.xxhash64("x", "y")), "binned"), "binned-parts")


def mixed(number: np.ndarray) -> np.ndarray:
    """SplitMix64 of whole numbers."""
    with np.errstate(over="ignore"):
        z = number + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _word(*numbers: int) -> np.uint64:
    word = np.zeros(1, np.uint64)
    for number in numbers:
        word = mixed(word ^ np.uint64(number & (1 << 64) - 1))
    return word[0]


def _poisson(mean: int) -> np.ndarray:
    most = mean + 12 * math.isqrt(mean) + 30
    k = np.arange(most)
    logs = k * math.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    return np.cumsum(np.exp(logs))


def poisson_weights(hashes: np.ndarray, counts: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row counts in a tree: for ``c`` equal rows a Poisson number of mean ``c``."""
    drawn = (mixed(hashes.view(np.uint64) ^ _word(seed, tree)) >> np.uint64(11)).astype(float) / (1 << 53)
    weights = np.zeros(len(drawn), np.int64)
    for count in np.unique(counts).tolist():
        own = counts == count
        weights[own] = np.searchsorted(_poisson(count), drawn[own], side="right")
    return weights


def some_features(seed: int, tree: int, nodes: np.ndarray, width: int, some: int) -> np.ndarray:
    """``some`` features for each node (rows), in order of their number; the same ones wherever the node is split."""
    if some >= width:
        return np.broadcast_to(np.arange(width), (len(nodes), width))
    out = np.empty((len(nodes), some), np.int64)
    salt = mixed(np.arange(width, dtype=np.uint64))
    for first in range(0, len(nodes), 8192):
        keys = mixed(nodes[first : first + 8192].astype(np.uint64) ^ _word(seed, tree, 1))
        out[first : first + 8192] = np.argpartition(mixed(keys[:, None] ^ salt[None, :]), some - 1, axis=1)[:, :some]
    return np.sort(out, axis=1)


def _better(gain: np.ndarray, n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether a cut explains more than the node's mean does, beyond rounding."""
    return gain > total.astype(float) ** 2 / n * (1 + 1e-12) + 1e-9


def _dense(keys, w, wy, nodes: int, bins: int, n, total):
    """Gain and bin of the best cut of each node, by a histogram of all its bins."""
    n_left = np.cumsum(np.bincount(keys, w, nodes * bins).reshape(nodes, bins), axis=1)[:, :-1]
    left = np.cumsum(np.bincount(keys, wy, nodes * bins).reshape(nodes, bins), axis=1)[:, :-1]
    n_right = n[:, None] - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left * left / n_left + (total[:, None] - left) ** 2 / n_right
    gain[(n_left <= 0) | (n_right <= 0)] = -np.inf
    best = gain.argmax(axis=1)
    return gain[np.arange(nodes), best], best


def _sparse(keys, w, wy, nodes: int, bins: int, n, total):
    """As ``_dense``, by the bins alone in which a node has rows."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    node, bin_ = np.divmod(keys[first], bins)
    starts = np.searchsorted(node, np.arange(nodes))
    n_left, left = np.cumsum(np.add.reduceat(w[order], first)), np.cumsum(np.add.reduceat(wy[order], first))
    n_left -= np.concatenate([[0.0], n_left])[starts][node]
    left -= np.concatenate([[0.0], left])[starts][node]
    n_right = n[node] - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left * left / n_left + (total[node] - left) ** 2 / n_right
    gain[n_right <= 0] = -np.inf
    top = np.maximum.reduceat(gain, starts)
    at = np.nonzero(gain == top[node])[0]
    best = np.empty(nodes, np.int64)
    best[node[at][::-1]] = bin_[at][::-1]
    return top, best


def finish(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, root: int, seed: int, some: int, depth: int, cuts: list[np.ndarray]
) -> pa.Table:
    """The subtree of a node with few rows of bins ``x``, label ``y`` and weight ``w``, level by level.

    Sums are of whole numbers and so are the same in any order. The label's mean is left out of them, which cuts share.
    Where nodes choose among all features, those of two bins are added up over the rows alone that are in the second.
    """
    count, width = x.shape
    columns = np.ascontiguousarray(x.T)
    flat, bins = columns.ravel(), np.array([len(c) + 1 for c in cuts])
    flags = np.nonzero(bins == 2)[0] if some >= width else np.array([], np.int64)
    ones = Ones(x[:, flags])
    middle = round(int((w * y).sum()) / int(w.sum()))
    out = Subtree(root, int(w.sum()), int((w * y).sum()))
    y = y - middle
    weights, weighted = w.astype(float), (w * y).astype(float)
    rows, nodes, counts = np.arange(count), np.array([root], np.int64), np.array([count])
    n, total = np.array([weights.sum()]), np.array([weighted.sum()])
    while len(nodes):
        starts, labels = np.cumsum(counts) - counts, y[rows]
        able = (np.minimum.reduceat(labels, starts) < np.maximum.reduceat(labels, starts)) & (nodes < 1 << depth)
        rows = rows[np.repeat(able, counts)]
        nodes, counts, n, total = nodes[able], counts[able], n[able], total[able]
        out.narrow(able)
        ones.keep(able)
        if not len(nodes):
            break
        owner = np.repeat(np.arange(len(nodes)), counts)
        own_w, own_wy = weights[rows], weighted[rows]
        gains, features, places = np.full(len(nodes), -np.inf), np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
        chosen = some_features(seed, tree, nodes, width, some)
        for slot in range(chosen.shape[1]):
            own = chosen[:, slot]
            if some >= width:
                if bins[slot] <= 2:
                    continue
                wide, values = int(bins[slot]), columns[slot][rows]
            else:
                wide, values = int(bins[own].max()), flat[own[owner] * count + rows]
                if wide == 1:
                    continue
            keys = owner * wide + values
            find = _dense if wide == 2 or len(nodes) * wide <= 2 * len(rows) else _sparse
            gain, place = find(keys, own_w, own_wy, len(nodes), wide, n, total)
            better = gain > gains
            gains[better], features[better], places[better] = gain[better], own[better], place[better]
        first = ones.groups(counts)
        if len(first):
            node = ones.nodes[first]
            n_right, right = np.add.reduceat(weights[ones.rows], first), np.add.reduceat(weighted[ones.rows], first)
            left = total[node] - right
            gain, group = best_of_groups(left * left / (n[node] - n_right) + right * right / n_right, node, len(nodes))
            found = np.where(group >= 0, flags[ones.flags[first]][group], -1)
            better = (gain > gains) | ((gain == gains) & (found >= 0) & (found < features))
            gains[better], features[better], places[better] = gain[better], found[better], 0
        split = (features >= 0) & _better(gains, n, total)
        inner = np.nonzero(split)[0]
        if not len(inner):
            break
        kept = split[owner]
        rows, owner = rows[kept], owner[kept]
        high_side = flat[features[owner] * count + rows] > places[owner]
        if len(ones.rows):
            side = np.zeros(count, bool)
            side[rows] = high_side
            ones.keep(split)
            ones.divide(side, len(inner))
        child = 2 * (np.cumsum(split) - 1)[owner] + high_side
        order = np.argsort(child, kind="stable")
        rows, counts = rows[order], np.bincount(child, minlength=2 * len(inner))
        starts = np.cumsum(counts) - counts
        n, total = np.add.reduceat(weights[rows], starts), np.add.reduceat(weighted[rows], starts)
        cut = np.array([cuts[f][b] for f, b in zip(features[inner].tolist(), places[inner].tolist())])
        whole = n.astype(np.int64)
        out.split(inner, features[inner], cut, whole, total.astype(np.int64) + middle * whole)
        nodes = np.stack([2 * nodes[inner], 2 * nodes[inner] + 1], axis=1).ravel()
    return out.table(tree)


def _top_level(
    table: DataFrame, tops: list[Top], nodes: list[tuple[int, int]], bins: np.ndarray, seed: int, some: int, depth: int, bag
) -> list[tuple]:
    """``(tree, node, feature, bin, n, total, n_left, left)`` of the nodes; feature -1: a leaf. One row for each node."""
    width, offsets = len(bins), np.cumsum(bins) - bins
    size = int(bins.sum())

    def choose(tree, node):
        return some_features(seed, tree, np.array([node]), width, some)[0].tolist()

    # Rows, labels in all, and both by bin of the features that the node has to choose from.
    def count(sums, tree, node, x, y, w):
        weights, weighted = w.astype(float), (w * y).astype(float)
        sums[-2] += weights.sum()
        sums[-1] += weighted.sum()
        for f in choose(tree, node):
            at, end = offsets[f], offsets[f] + bins[f]
            sums[at:end] += np.bincount(x[:, f], weights, bins[f])
            sums[size + at : size + end] += np.bincount(x[:, f], weighted, bins[f])

    found = []
    for group in passes(nodes, 16 * size):
        sums = add_up(
            table, tops, group, width, lambda: np.zeros(2 * size + 2), count, lambda parts: np.sum(parts, axis=0), bag
        )
        for tree, node, data in sums.collect():
            both = np.frombuffer(data)
            n, total = both[-2:]
            middle = round(total / n)
            best = (-np.inf, -1, 0, 0.0, 0.0)
            for f in choose(tree, node) if node < 1 << depth else []:
                at, end = offsets[f], offsets[f] + bins[f]
                n_left, left = np.cumsum(both[at:end])[:-1], np.cumsum(both[size + at : size + end])[:-1]
                if not len(n_left):
                    continue
                a, b = left - middle * n_left, (total - left) - middle * (n - n_left)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where((n_left > 0) & (n_left < n), a * a / n_left + b * b / (n - n_left), -np.inf)
                place = int(gain.argmax())
                if gain[place] > best[0]:
                    best = (gain[place], f, place, n_left[place], left[place])
            gain, feature, place, n_left, left = best
            if not _better(np.array(gain), n, np.array(total - middle * n)):
                feature = -1
            found.append((tree, node, feature, float(place), int(n), int(total), int(n_left), int(left)))
    return found


def grow(
    rows: DataFrame, trees: int = 100, seed: int = 42, depth: int = 30, some: int | None = None, bins: int = BINS,
    local_rows: int = LOCAL_ROWS,
) -> Forest:
    """Trees over all ``rows(x, y)``: ``x`` an array of doubles without NULL, ``y`` whole numbers (``trees.in_units``).

    A node has ``some`` features to choose from, all by default. A node of one label, without a cut that explains more,
    or ``depth`` levels below the root is a leaf.
    """
    table = encode(rows)
    first = table.first()
    width = len(first["x"]) // 8 if first else 1
    some = min(some or width, width)
    cuts = cut_points(table, width, bins)
    numbers = np.array([len(c) + 1 for c in cuts])
    bagged = binned(table, cuts)
    held = bagged.agg(F.count("*").alias("rows"), F.sum("c").alias("n")).first()

    def bag(tree: int, batch: pa.RecordBatch) -> np.ndarray:
        return poisson_weights(batch.column("h").to_numpy(), batch.column("c").to_numpy(), seed, tree)

    def split(tops, nodes):
        return _top_level(bagged, tops, nodes, numbers, seed, some, depth, bag)

    tops, leaves, deep = grow_top(trees, held["n"] or 0, local_rows, depth, split)
    local = lambda x, y, w, tree, node: finish(x, y, w, tree, node, seed, some, depth, cuts)
    subtrees = finish_dealt(bagged, tops, leaves, width, held["rows"], local, bag)
    real = [
        (nodes, features, np.array([cuts[f][int(b)] for f, b in zip(features.tolist(), places.tolist())], float))
        for nodes, features, places in tops
    ]
    return as_forest(table, real, subtrees, deep)
