"""Exact comparison of bit fingerprints, tile against tile, with numpy."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import store

TILE_ROWS, TILE_SIZE = 16_384, 1 << 21
_BLOCK = 1 << 18  # comparisons made at once: their numpy arrays stay in the processor's cache
_MANY = 1_000_000  # links held before they are thinned to a forest
_SIZE_STEP = 0.05
_TILE = ["pop", "band", "part"]
_TESTED = 1 << 20  # hashes looked up in one test of candidates


def layers(a: np.ndarray, b: np.ndarray, distance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of some links ``a[i]`` - ``b[i]`` and the layer of each: 1 for a minimum spanning forest of the links
    (Kruskal, nearest first), 2 for one of the links that are left, and so on up to ``count``.

    Of the links across any cut the nearest ``count`` are kept, so there are at most that many for each node, and a
    group of ``count + 1`` nodes or fewer keeps them all.
    """
    left = np.lexsort((b, a, distance))
    kept, layer = [], []
    for number in range(1, count + 1):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, x)
            return top

        own = np.zeros(len(left), bool)
        for k, (x, y) in enumerate(zip(a[left].tolist(), b[left].tolist())):
            if (x := root(x)) != (y := root(y)):
                parent[max(x, y)] = min(x, y)
                own[k] = True
        kept.append(left[own])
        layer.append(np.full(int(own.sum()), number, np.int32))
        left = left[~own]
        if not len(left):
            break
    return np.concatenate(kept), np.concatenate(layer)


def _linked(left, right, radius: int, ratio: float | None, same: bool) -> Iterator[tuple]:
    """Rows of both tiles that link and the number of differing bits, in blocks."""
    (nodes_a, words_a, sizes_a), (nodes_b, words_b, sizes_b) = left, right
    columns = [np.ascontiguousarray(words_b[:, w]) for w in range(words_b.shape[1])]
    step = max(1, _BLOCK // max(1, len(nodes_b)))
    for start in range(0, len(nodes_a), step):
        rows = words_a[start : start + step]
        differing = np.bitwise_count(rows[:, :1] ^ columns[0][None, :])
        if len(columns) > 1:
            differing = differing.astype(np.uint16)
            for w in range(1, len(columns)):
                differing += np.bitwise_count(rows[:, w : w + 1] ^ columns[w][None, :])
        i, j = np.nonzero(differing <= radius)
        d = differing[i, j].astype(np.int32)
        i = i + start
        keep = i < j if same else np.ones(len(i), dtype=bool)
        if ratio is not None and len(i):
            x, y = sizes_a[i], sizes_b[j]
            keep &= np.minimum(x, y) >= ratio * np.maximum(x, y) - 1e-9
        yield i[keep], j[keep], d[keep]


def _nothing():
    return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)


def compare(left, right, radius: int, ratio: float | None, same: bool, count: int = 1):
    """Layers of the links between two tiles: arrays of both nodes, the number of differing bits, and the layer.

    A tile is (nodes, words, sizes); words has a row for each fingerprint, as 64-bit words. Two rows link if
    at most ``radius`` bits differ and, with a ``ratio``, the smaller size is at least that share of the larger.
    """
    parts: list[tuple] = []
    held = 0

    def thinned():
        a, b, d = (np.concatenate(x) for x in zip(*parts))
        keep, layer = layers(a, b, d, count)
        return a[keep], b[keep], d[keep], layer

    for i, j, d in _linked(left, right, radius, ratio, same):
        if len(i):
            parts.append((left[0][i], right[0][j], d))
            held += len(i)
            if held > _MANY:
                parts[:] = [thinned()[:3]]
                held = 0
    return thinned() if parts else _nothing()


def _unpacked(rows: pa.StructArray, width: int):
    fields = [rows.field(i).to_numpy(zero_copy_only=False) for i in range(width + 2)]
    return fields[0], np.stack([f.view(np.uint64) for f in fields[1:-1]], axis=1), fields[-1]


def tile_pairs(
    prints: DataFrame, words: list[str], radius: int, ratio: float | None = None, tile_rows: int = TILE_ROWS,
    tile_size: int = TILE_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """Tiles ``(pop, band, part, rows)`` of ``prints(node, size, *words)``, and the sides ``(pair, side, pop, band, part)``
    of the pairs of tiles to be compared; ``node`` is a unique long.

    Rows are dealt to tiles by population count, and by size where a ``ratio`` bounds it; a class of
    counts is cut by hash into tiles of about ``tile_rows`` whose sizes sum up to about ``tile_size``. Tile pairs whose population counts differ by more
    than ``radius`` bits (or whose sizes can't meet the ratio) are never paired.
    """
    spark = prints.sparkSession
    pop_step = max(1, radius // 2)
    pop_reach = math.ceil(radius / pop_step)
    size_reach = math.ceil(-math.log(ratio) / _SIZE_STEP + 1e-9) if ratio is not None else 0
    population = sum((F.bit_count(F.col(w)) for w in words), F.lit(0))
    size_band = F.floor(F.log(F.greatest(F.col("size"), F.lit(1)).cast("double")) / _SIZE_STEP) if size_reach else F.lit(0)
    keyed = prints.select(
        "node", "size", *words,
        F.floor(population / pop_step).cast("int").alias("pop"), size_band.cast("int").alias("band"),
    )
    # One row for each population count and size class: bounded by their number, whatever the corpus holds.
    parts = F.ceil(F.greatest(F.count("*") / tile_rows, F.sum("size") / tile_size)).cast("int")
    counts = keyed.groupBy("pop", "band").agg(parts.alias("parts"))
    rows = [(r["pop"], r["band"], r["parts"]) for r in counts.collect()]
    shares = spark.createDataFrame(rows, "pop int, band int, parts int")
    tiles = store(
        keyed.join(F.broadcast(shares), ["pop", "band"])
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .groupBy("pop", "band", "part")
        .agg(F.collect_list(F.struct("node", *words, "size")).alias("rows")),
        "tiles",
    )
    names = tiles.select("pop", "band", "part")
    reach = F.array(*[
        F.struct(F.lit(p).alias("p"), F.lit(b).alias("b"))
        for b in range(size_reach + 1) for p in range(-pop_reach, pop_reach + 1) if b > 0 or p >= 0
    ])
    partner = names.select("pop", "band", "part", F.explode(reach).alias("to")).select(
        "pop", "band", "part", (F.col("pop") + F.col("to.p")).alias("pop2"), (F.col("band") + F.col("to.b")).alias("band2")
    )
    others = names.select(F.col("pop").alias("pop2"), F.col("band").alias("band2"), F.col("part").alias("part2"))
    pairs = partner.join(others, ["pop2", "band2"]).filter(
        "pop <> pop2 OR band <> band2 OR part <= part2"
    )
    second = F.struct(F.col("pop2").alias("pop"), F.col("band2").alias("band"), F.col("part2").alias("part"))
    sides = pairs.select(
        F.concat_ws(":", *_TILE, "pop2", "band2", "part2").alias("pair"),
        F.posexplode(F.array_distinct(F.array(F.struct("pop", "band", "part"), second))).alias("side", "t"),
    ).select("pair", "side", "t.pop", "t.band", "t.part")
    return tiles, sides


_TILE = ["pop", "band", "part"]
def near_nodes(tiles: DataFrame, sides: DataFrame, words: int, radius: int, ratio: float | None = None) -> DataFrame:
    """``(pair, side, node)``: the nodes of each side of a tile pair that have a link in it; one row for each at most."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("side")
        sides = [_unpacked(tile.values, words) for tile in group.column("rows")]
        left, right = sides[0], sides[-1]
        linked = [np.zeros(len(side[0]), bool) for side in sides]
        for i, j, _ in _linked(left, right, radius, ratio, len(sides) == 1):
            linked[0][i] = True
            linked[-1][j] = True
        nodes = [side[0][own] for side, own in zip(sides, linked)]
        number = sum(map(len, nodes))
        return pa.table({
            "pair": pa.array([group.column("pair")[0].as_py()] * number, pa.string()),
            "side": pa.array(np.repeat(np.arange(len(nodes)), [len(n) for n in nodes]), pa.int32()),
            "node": pa.array(np.concatenate(nodes), pa.int64()),
        })

    both = sides.join(tiles, _TILE).select("pair", "side", "rows")
    return both.groupBy("pair").applyInArrow(run, "pair string, side int, node bigint")


class _Sets:
    """Sorted hashes of rows end to end, as dense numbers common to the two sides that are compared."""

    def __init__(self, left: list[np.ndarray], right: list[np.ndarray]):
        sizes = [np.array([len(x) for x in side], np.int64) for side in (left, right)]
        empty = np.empty(0, np.uint64)
        every, self.number = np.unique(np.concatenate([empty, *left, *right]), return_inverse=True)
        self.kinds = len(every)
        cut = int(sizes[0].sum())
        self.sizes = sizes
        self.begins = np.cumsum(sizes[0]) - sizes[0]
        # Rows in order and hashes in order inside a row: the codes of the right side are sorted as they are.
        self.codes = np.repeat(np.arange(len(right)), sizes[1]) * self.kinds + self.number[cut:]

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many hashes row ``i`` of the left and row ``j`` of the right have in common."""
        n = self.sizes[0][i]
        ends = np.cumsum(n)
        of = np.repeat(np.arange(len(i)), n)
        at = np.arange(int(n.sum())) - np.repeat(ends - n - self.begins[i], n)
        wanted = j[of] * self.kinds + self.number[at]
        place = np.minimum(np.searchsorted(self.codes, wanted), max(0, len(self.codes) - 1))
        return np.bincount(of[self.codes[place] == wanted], minlength=len(i)) if len(self.codes) else np.zeros(len(i), int)


def confirmed(left, right, radius: int, likeness: float, same: bool) -> tuple[list, list]:
    """Nodes of both ends of a forest of the links between two sides whose sets of hashes have that Jaccard likeness.

    A side is (nodes, words, sizes, sets). A candidate is within ``radius`` bits; it is tested only if nothing found so
    far joins its ends, nearest first, so a group of copies takes few tests and gives one link for each node but one.
    """
    sets = _Sets(left[3], right[3])
    parent = np.arange(len(left[0]) + (0 if same else len(right[0])))
    shift = 0 if same else len(left[0])

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def flatten():
        while (up := parent[parent]).tolist() != parent.tolist():
            parent[:] = up

    src, dst = [], []
    for i, j, distance in _linked(left[:3], right[:3], radius, likeness, same):
        order = np.argsort(distance, kind="stable")
        i, j = i[order], j[order]
        while len(i):
            flatten()
            apart = parent[i] != parent[j + shift]
            i, j = i[apart], j[apart]
            most = max(1, int(np.searchsorted(np.cumsum(sets.sizes[0][i]), _TESTED)))
            x, y, i, j = i[:most], j[:most], i[most:], j[most:]
            if not len(x):
                break
            common = sets.shared(x, y)
            good = common >= likeness * (sets.sizes[0][x] + sets.sizes[1][y] - common) - 1e-9
            for a, b in zip(x[good].tolist(), y[good].tolist()):
                if (up := root(a)) != (down := root(b + shift)):
                    parent[max(up, down)] = min(up, down)
                    src.append(int(left[0][a]))
                    dst.append(int(right[0][b]))
    return src, dst


def confirmed_links(near: DataFrame, sets: DataFrame, words: list[str], radius: int, likeness: float) -> DataFrame:
    """``(src, dst)``: for each tile pair of ``near(pair, side, node)`` a forest of the links whose sets have the likeness.

    ``sets(node, size, *words, hashes)`` has sorted distinct 64-bit hashes as bytes. Only nodes with a candidate are sent,
    once to each tile pair in which they have one; likeness is tested there, and at most one link a node comes out.
    """

    def side(group: pa.Table, number: int):
        own = group.filter(pc.equal(group.column("side"), number))
        prints = np.stack([own.column(w).to_numpy().view(np.uint64) for w in words], axis=1)
        hashes = [np.frombuffer(h, np.uint64) for h in own.column("hashes").to_pylist()]
        return own.column("node").to_numpy(), prints, own.column("size").to_numpy(), hashes

    def run(group: pa.Table) -> pa.Table:
        names = group.column("pair")[0].as_py().split(":")
        same = names[:3] == names[3:]
        left = side(group, 0)
        right = left if same else side(group, 1)
        src, dst = confirmed(left, right, radius, likeness, same)
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return near.join(sets, "node").groupBy("pair").applyInArrow(run, "src bigint, dst bigint")


def tiled_links(
    prints: DataFrame, words: list[str], radius: int, ratio: float | None = None, tile_rows: int = TILE_ROWS,
    count: int = 1,
) -> DataFrame:
    """Links of ``prints(node, size, *words)`` as ``(src, dst, distance, layer)``; ``node`` is a unique long.

    The pairs of ``tile_pairs`` are compared in full, pair by pair in tasks of their own. Of the links inside one tile
    pair ``count`` layers of spanning forests are returned. The first keeps who reaches whom, at every distance up to the
    radius, without listing all pairs of a large group. Empty input gives no link.
    """
    tiles, sides = tile_pairs(prints, words, radius, ratio, tile_rows)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("side")
        sides = [_unpacked(tile.values, len(words)) for tile in group.column("rows")]
        found = compare(sides[0], sides[-1], radius, ratio, len(sides) == 1, count)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table({n: pa.array(x, k) for n, x, k in zip(("src", "dst", "distance", "layer"), found, kinds)})

    both = sides.join(tiles, _TILE).select("pair", "side", "rows")
    return both.groupBy("pair").applyInArrow(run, "src bigint, dst bigint, distance int, layer int")
