"""Poisson bootstrap of metrics that follow from sums over rows, all replicates in one pass.

In every replicate a row counts as often as a Poisson number of mean 1 says, which is drawn from a hash of its key.
So replicates need neither a sort nor a row count, are the same for any partitioning, and add up in the tasks that
read the rows: what is shuffled is a row for each task and replicate. Digests are of many rows at once.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.hashing import HASH_SPAN, ONE_BLOCK, md5_words, one_block

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DRAWS = 4  # a digest of 32 hex digits has four draws of 32 bits
_MOST = 12


def poisson_cuts() -> list[int]:
    """A draw below the k-th bound, and not below an earlier one, has weight k; one beyond all has the next weight."""
    cuts, total, term = [], 0.0, math.exp(-1)
    for k in range(_MOST):
        total += term
        cuts.append(int(HASH_SPAN * total))
        term /= k + 1
    return cuts


def _padded(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys as rows of bytes, with zeros after each, and their lengths."""
    lengths = np.array([len(k) for k in keys])
    padded = np.zeros((len(keys), max(1, lengths.max())), np.uint8)
    padded[np.arange(padded.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(keys), np.uint8)
    return padded, lengths


def _draws(keys: list[bytes], padded: np.ndarray, lengths: np.ndarray, head: bytes) -> list[np.ndarray]:
    """The four draws of the digest of ``head`` and each key."""
    if len(head) + padded.shape[1] > ONE_BLOCK:
        digests = b"".join(hashlib.md5(head + key).digest() for key in keys)
        return list(np.frombuffer(digests, ">u4").reshape(-1, DRAWS).T.astype(np.int64))
    messages = np.empty((len(keys), len(head) + padded.shape[1]), np.uint8)
    messages[:, : len(head)], messages[:, len(head) :] = np.frombuffer(head, np.uint8), padded
    return md5_words(one_block(messages, lengths + len(head)))


def replicate_sums(
    df: DataFrame, key: Sequence[str], sums: dict[str, Column], replicates: int = 100, seed: int = 42
) -> DataFrame:
    """``(replicate, n, *sums)``: weighted number of rows and weighted sums; replicate 0 is the table itself.

    Draws come from ``md5('seed:block:key:...')``, a block being four replicates and a null key an empty text. Rows with
    equal keys have equal weights. NULLs are left out of sums. An empty table gives no rows.
    """
    names, cuts = list(sums), np.array(poisson_cuts())
    text = F.concat_ws(":", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in key])
    rows = df.select(text.alias("__key"), *[sums[n].cast("double").alias(n) for n in names])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, known = np.zeros((replicates + 1, len(names) + 1)), np.zeros(len(names), np.int64)
        any_rows = False
        for batch in batches:
            keys = [k.encode() for k in batch.column(0).to_pylist()]
            values = np.ones((len(keys), len(names) + 1))
            for j in range(len(names)):
                column = batch.column(j + 1)
                known[j] += len(column) - column.null_count
                values[:, j + 1] = column.fill_null(0.0).to_numpy(zero_copy_only=False)
            any_rows = any_rows or bool(keys)
            totals[0] += values.sum(axis=0)
            if not keys:
                continue
            padded, lengths = _padded(keys)
            for block in range((replicates - 1) // DRAWS + 1):
                for j, draw in enumerate(_draws(keys, padded, lengths, f"{seed}:{block}:".encode())):
                    if block * DRAWS + j < replicates:
                        weights = np.searchsorted(cuts, draw, side="right").astype(float)
                        totals[block * DRAWS + j + 1] += weights @ values
        if any_rows:
            counts = [pa.array([count] * (replicates + 1), pa.int64()) for count in known.tolist()]
            columns = [pa.array(range(replicates + 1), pa.int32()), *[pa.array(column) for column in totals.T], *counts]
            yield pa.record_batch(columns, ["replicate", *[f"c{k}" for k in range(1, len(columns))]])

    # Names of their own, so that a sum may be called n.
    parts = [f"c{k} double" for k in range(1, len(names) + 2)] + [f"c{k} bigint" for k in range(len(names) + 2, 2 * len(names) + 2)]
    added = rows.mapInArrow(add_up, ", ".join(["replicate int", *parts])).groupBy("replicate")
    known = [F.sum(f"c{k + len(names) + 2}") > 0 for k in range(len(names))]
    return added.agg(
        F.sum("c1").cast("bigint").alias("n"), *[F.when(known[k], F.sum(f"c{k + 2}")).alias(n) for k, n in enumerate(names)]
    )


def intervals(replicated: DataFrame, metrics: dict[str, Column], level: float = 0.95) -> DataFrame:
    """``(metric, estimate, low, high, replicates)`` from the output of :func:`replicate_sums`, a small table.

    The estimate is the table's own; low and high are interpolated quantiles over replicates in which the metric is
    defined, and NULL when there is none.
    """
    values = replicated.select("replicate", *[m.alias(name) for name, m in metrics.items()])
    drawn = F.col("replicate") > 0
    tail = (1 - level) / 2

    def quantile(name: str, share: float) -> Column:
        return F.percentile(F.when(drawn, F.col(name)), F.lit(share))

    found = values.agg(*[
        F.struct(
            F.lit(name).alias("metric"), F.max(F.when(~drawn, F.col(name))).alias("estimate"),
            quantile(name, tail).alias("low"), quantile(name, 1 - tail).alias("high"),
            F.count(F.when(drawn, F.col(name))).alias("replicates"),
        ).alias(name)
        for name in metrics
    ])
    return found.select(F.inline(F.array(*[F.col(n) for n in metrics])))


def regression_intervals(
    predictions: DataFrame, label: str, key: Sequence[str], replicates: int = 100, seed: int = 42, level: float = 0.95
) -> DataFrame:
    """RMSE, MAE and R2 with their intervals; rows without a label or prediction are left out."""
    actual, predicted = F.col(label).cast("double"), F.col("prediction")
    error = actual - predicted
    kept = predictions.filter(error.isNotNull())
    sums = {"squared": error * error, "size": F.abs(error), "label": actual, "label_squared": actual * actual}
    replicated = replicate_sums(kept, key, sums, replicates, seed)
    n, squared = F.col("n"), F.col("squared")
    spread = F.col("label_squared") - F.try_divide(F.col("label") * F.col("label"), n)
    return intervals(
        replicated,
        {
            "rmse": F.sqrt(F.try_divide(squared, n)),
            "mae": F.try_divide(F.col("size"), n),
            "r2": 1 - F.try_divide(squared, spread),
        },
        level,
    )


def classification_intervals(
    predictions: DataFrame, label: str, key: Sequence[str], replicates: int = 100, seed: int = 42, level: float = 0.95,
    positive: int = 1,
) -> DataFrame:
    """Accuracy, and F1 of the positive class, with their intervals; rows without a class on either side are left out."""
    actual, predicted = F.col(label).cast("int"), F.col("prediction").cast("int")
    kept = predictions.filter(actual.isNotNull() & predicted.isNotNull())
    sums = {
        "right": (actual == predicted).cast("int"),
        "found": ((actual == positive) & (predicted == positive)).cast("int"),
        "total": (actual == positive).cast("int") + (predicted == positive).cast("int"),
    }
    replicated = replicate_sums(kept, key, sums, replicates, seed)
    f1 = F.coalesce(F.try_divide(F.col("found") * 2, F.col("total")), F.lit(0.0))
    return intervals(
        replicated,
        {"accuracy": F.try_divide(F.col("right"), F.col("n")), "f1": F.when(F.col("n") > 0, f1)},
        level,
    )
