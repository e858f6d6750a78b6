"""Centroid clustering in whole numbers; the nearest centroid is the winner of a tournament of bisectors."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import store

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
_EXACT = 1 << 53  # whole numbers below it are exact as doubles, in whatever order they are added
_LIMB = 40  # bits of a part of a sum: 2^23 of them fit a long
_LONG = (1 << 63) - 1


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` for finite doubles: as doubles where all are exact, else as Python's whole numbers."""
    if not values.size or np.abs(values).max() * scale < 1 << 40:
        return np.floor(values * scale)
    # From 2^53 on a double is a whole number, and the product might leave the doubles.
    plain = [int(x) * scale if abs(x) >= _EXACT else math.floor(x * scale) for x in values.ravel().tolist()]
    return np.array(plain, object).reshape(values.shape)


class Bisectors:
    """Planes between pairs of centroids: ``normal . x - threshold`` is positive where the larger number is nearer.

    For centroids a and b, |x - a|^2 - |x - b|^2 = 2 (b - a) . x - (|b|^2 - |a|^2). A test costs one product, and
    k - 1 of them leave one centroid: the winner so far against each next one.
    """

    def __init__(self, centroids: list[list[int]]):
        exact = np.array(centroids, object).reshape(len(centroids), -1)
        self.centroids = exact
        squares = [int(sum(x * x for x in c)) for c in exact]
        k = len(centroids)
        self.normals = {(a, b): 2 * (exact[b] - exact[a]) for b in range(k) for a in range(b)}
        self.thresholds = {(a, b): squares[b] - squares[a] for a, b in self.normals}
        self.reach = max([abs(int(x)) for x in exact.ravel()], default=0)
        if self._fits(self.reach):
            self.normal_doubles = {pair: n.astype(np.float64) for pair, n in self.normals.items()}

    def _fits(self, largest: int) -> bool:
        """Whether all sums of a test and of a distance are exact as doubles."""
        d = self.centroids.shape[1] if len(self.centroids) else 0
        return d * (largest + self.reach) * (4 * self.reach + largest + 1) < _EXACT

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row of whole numbers (ties: the smaller number), and its squared distance."""
        winner = np.zeros(len(rows), np.int64)
        fits = rows.dtype != object and (not rows.size or self._fits(int(np.abs(rows).max())))
        if not fits:
            rows = rows if rows.dtype == object else _python_numbers(rows)
        normals = self.normal_doubles if fits else self.normals
        for challenger in range(1, len(self.centroids)):
            held = winner.copy()
            for champion in np.unique(held).tolist():
                at = np.nonzero(held == champion)[0]
                side = rows[at] @ normals[champion, challenger] - self.thresholds[champion, challenger]
                winner[at[side > 0]] = challenger
        away = rows - (self.centroids.astype(np.float64) if fits else self.centroids)[winner]
        return winner, (away * away).sum(axis=1)


def _python_numbers(rows: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in rows.ravel().tolist()], object).reshape(rows.shape)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    """``(place, part)`` with total = sum of part * 2^(40 place), every part with the sign of the total."""
    sign, rest, place = (-1 if total < 0 else 1), abs(total), 0
    while rest:
        if part := rest & ((1 << _LIMB) - 1):
            yield place, sign * part
        rest, place = rest >> _LIMB, place + 1


def _vectors(batch: pa.RecordBatch, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the rows that are kept, and their components as doubles."""
    column = batch.column("vector")
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.nonzero(lengths == dimensions)[0]
    values = column.take(pa.array(at)).flatten()
    doubles = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    good = np.isfinite(doubles).all(axis=1)
    return at[good], doubles[good]


def _sums(vectors: DataFrame, bisectors: Bisectors, dimensions: int, scale: int) -> list[tuple[int, list[int]]]:
    """For each centroid the number of its vectors and the exact sum of each component.

    A task sends one row for each centroid, component and place of 40 bits; these are at most
    k * (d + 1) * 28 different ones, whatever the number of vectors, so the sums come to the driver.
    """
    k = len(bisectors.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = [0] * k, [[0] * dimensions for _ in range(k)]
        for batch in batches:
            _, doubles = _vectors(batch, dimensions)
            rows = whole(doubles, scale)
            winner, _ = bisectors.nearest(rows)
            for c in np.unique(winner).tolist():
                own = rows[winner == c]
                counts[c] += len(own)
                added = own.astype(np.int64).sum(axis=0) if own.dtype != object else own.sum(axis=0)
                totals[c] = [t + int(a) for t, a in zip(totals[c], added)]
        rows = [
            (c, j, place, part)
            for c in range(k) for j, total in enumerate([*totals[c], counts[c]]) for place, part in _limbs(total)
        ]
        columns = [pa.array([r[n] for r in rows], kind) for n, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))]
        yield pa.record_batch(columns, names=["cluster", "component", "place", "part"])

    parts = vectors.select("vector").mapInArrow(run, "cluster int, component int, place int, part bigint")
    out = [[0] * (dimensions + 1) for _ in range(k)]
    for r in parts.groupBy("cluster", "component", "place").agg(F.sum("part").alias("part")).collect():
        out[r["cluster"]][r["component"]] += r["part"] << (_LIMB * r["place"])
    return [(row[-1], row[:-1]) for row in out]


def first_centroids(vectors: DataFrame, clusters: int, dimensions: int, scale: int, seed: int) -> list[list[int]]:
    """Whole-number vectors of the ids with the smallest ``sha256(seed:id)``; equal ids by their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _ = _vectors(batch, dimensions)
            yield batch.take(pa.array(at))

    kept = vectors.select("id", "vector").mapInArrow(run, vectors.select("id", "vector").schema)
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.withColumn("hash", F.sha2(named, 256)).orderBy("hash", "vector").limit(clusters).collect()
    return [[int(x) for x in whole(np.array(r["vector"], np.float64), scale)] for r in rows]


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every kept vector.

    Kept are vectors of exactly ``dimensions`` components, none null, infinite or not a number; other rows have no
    result. A component x becomes floor(scale * x). Centroids start as the vectors whose id has the smallest sha256
    of ``seed:id`` (a null id is empty text; fewer vectors, fewer centroids; equal vectors stay, the smaller number
    takes all). Each round assigns every vector and replaces each centroid that has vectors by floor(sum / count).
    All of it is exact at any size of component; a distance or sum of distances beyond a long is null. Repeated
    rows count and are returned as often as they occur; an empty table gives an empty result.

    Rounds are one pass over the table each, of which a task sends sums only. Centroids travel with the tasks: their
    number is a parameter.
    """
    kind = df.schema[vector_col].dataType
    array = F.col(f"`{vector_col}`")
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        array = array.cast("array<double>")
    vectors = df.select(F.col(f"`{id_col}`").alias("id"), array.alias("vector"))
    id_type = vectors.schema["id"].dataType.simpleString()
    centroids = first_centroids(vectors, clusters, dimensions, scale, seed)
    if not centroids:
        more = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return df.sparkSession.createDataFrame([], f"id {id_type}, {more}")
    for _ in range(rounds):
        sums = _sums(vectors, Bisectors(centroids), dimensions, scale)
        moved = [[s // n for s in total] if n else old for old, (n, total) in zip(centroids, sums)]
        if moved == centroids:
            break  # all further rounds are the same
        centroids = moved
    bisectors = Bisectors(centroids)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, doubles = _vectors(batch, dimensions)
            winner, distance = bisectors.nearest(whole(doubles, scale))
            exact = [None if d > _LONG else int(d) for d in distance.tolist()]
            columns = [batch.column("id").take(pa.array(at)), pa.array(winner.astype(np.int32)), pa.array(exact, pa.int64())]
            yield pa.record_batch(columns, names=["id", "cluster", "distance"])

    assigned = vectors.mapInArrow(run, f"id {id_type}, cluster int, distance bigint")
    assigned = store(assigned, "assigned")
    # One row for each cluster; a sum with a missing distance is missing.
    summed = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole_sum = F.when(F.count("distance") == F.count("*"), summed).alias("total")
    totals = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(whole_sum).collect()}
    fits = {c: None if t is None or t > _LONG else int(t) for c, t in totals.items()}
    inertia = None if None in totals.values() or sum(totals.values()) > _LONG else int(sum(totals.values()))
    rows = [(c, fits[c], inertia, digests[c]) for c in fits]
    named = df.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    # One row a cluster: bounded by the parameter.
    return assigned.join(F.broadcast(named), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
