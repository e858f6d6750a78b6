"""Resampling towards a target distribution: hashed n-gram weights, Gumbel scores, a cutoff by bisection."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import id_and_text, map_batches, store, texts
from ratelens.operators.ranking import dense_row_number

ORDER, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, 2024
_STEPS = 16  # parts into which one count job cuts the range that is left

#: Fixed value: what separates words is U+0000 to U+002F, U+003A to U+0060 and U+007B to U+007F, after A-Z are
#: lower-cased. All of UTF-8's longer characters have bytes from 128 on.
_TO_SPACE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def feature_buckets(found: list[bytes], order: int, buckets: int) -> np.ndarray:
    """The bucket of each run of 1 to ``order`` words, joined by a space; repeats included."""
    crc = zlib.crc32
    runs = [crc(b" ".join(found[k : k + n])) for n in range(1, order + 1) for k in range(len(found) - n + 1)]
    return np.array(runs, np.int64) % buckets


def bucket_counts(df: DataFrame, text_col: str, order: int, buckets: int) -> np.ndarray:
    """How many features of all texts are in each bucket; as many rows as buckets come to the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in texts(batch):
                total += np.bincount(feature_buckets(words(text), order, buckets), minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.record_batch({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    source = df.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = source.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets))))`` of each bucket."""
    buckets = len(source)
    every, wanted = float(source.sum() + buckets), float(target.sum() + buckets)
    pairs = zip(source.astype(float).tolist(), target.astype(float).tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * every / ((s + 1) * wanted))) for s, t in pairs], np.int64)


def weights(df: DataFrame, gain: np.ndarray, order: int) -> DataFrame:
    """``(id, n_words, n_features, weight)`` of ``df(id, text)``: the sum of the gains of all features of a text."""
    buckets = len(gain)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in texts(batch):
            found = words(text)
            at = feature_buckets(found, order, buckets)
            rows.append((len(found), len(at), int(gain[at].sum())))
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        return pa.record_batch([batch.column("id"), *columns], names=["id", "n_words", "n_features", "weight"])

    kind = df.schema["id"].dataType.simpleString()
    return map_batches(df, run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(id_col: Column, seed: int) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2^32)))``, h the first 8 hex digits of ``sha256(seed:id)``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _first_within(rows: DataFrame, column: str, wanted: int) -> tuple[int, int]:
    """The largest v with fewer than ``wanted`` rows of ``column < v``, and the number of those rows.

    The range is cut again and again by exact counts of all rows below some values, until one value is left: the one
    in which the row with that number lies. A count job takes four bits of the range.
    """
    bounds = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high, below = bounds["low"], bounds["high"], 0
    while low < high:
        cuts = sorted({low + (high - low + 1) * k // _STEPS for k in range(1, _STEPS)} - {low})
        counted = rows.agg(*[F.count(F.when(F.col(column) < cut, 1)).alias(f"c{k}") for k, cut in enumerate(cuts)]).first()
        for k, cut in enumerate(cuts):
            if counted[k] < wanted:
                low, below = cut, counted[k]
            else:
                high = cut - 1
                break
    return low, below


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    order: int = ORDER,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every row of ``df``; rank is null for rows not drawn.

    A feature's gain compares how often its bucket occurs in ``target`` and in ``df``; a text's weight is the sum of
    its features' gains, and its score adds noise from the hash of the id alone. Of the N rows with at least
    ``least_words`` words the floor(percent * N / 100) highest scores are drawn, ties to the smaller id, a null id
    last; of rows equal in both any, but always that many. A null text is empty: weight 0. Ids are whole numbers.
    Repeated rows are rows of their own; an empty table gives an empty result, an empty target gains from counts of 0.

    Nothing is sorted to find the cutoff: scores are a stored table, and a few count jobs over it bisect the score,
    then the id among rows with that score. Only rows that are drawn are range-partitioned for their ranks.
    """
    gain = gains(
        bucket_counts(df, text_col, order, buckets), bucket_counts(target, target_text_col, order, buckets)
    )
    weighed = weights(id_and_text(df, id_col, text_col), gain, order)
    scored = store(
        weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
        .withColumn("position", F.monotonically_increasing_id()),
        "resample-scores",
    )
    able = scored.filter(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    plain = ["id", "n_features", "weight", "score"]
    none = scored.select(*plain, F.lit(None).cast("bigint").alias("rank"))
    if not wanted:
        return none
    falling = able.withColumn("fall", -F.col("score"))
    cutoff, above = _first_within(falling, "fall", wanted)
    # Rows of the cutoff's score: null ids come after all others, equal ids in the stored order.
    tied = falling.filter(F.col("fall") == cutoff)
    named, unnamed = tied.filter("id IS NOT NULL"), tied.filter("id IS NULL")
    rest, numbers = wanted - above, named.count()
    if rest <= numbers:
        last, before = _first_within(named, "id", rest)
        at, _ = _first_within(named.filter(F.col("id") == last), "position", rest - before)
        drawn_ties = (F.col("id") < last) | ((F.col("id") == last) & (F.col("position") <= at))
    else:
        at, _ = _first_within(unnamed, "position", rest - numbers)
        drawn_ties = F.col("id").isNotNull() | (F.col("position") <= at)
    drawn = (F.col("n_words") >= least_words) & (
        (-F.col("score") < cutoff) | ((-F.col("score") == cutoff) & F.coalesce(drawn_ties, F.lit(False)))
    )
    chosen = dense_row_number(
        scored.filter(drawn).withColumn("fall", -F.col("score")),
        [F.col("fall").asc(), F.col("id").asc_nulls_last(), F.col("position").asc()],
        output="rank",
    )
    left = scored.filter(~drawn).select(*plain, F.lit(None).cast("bigint").alias("rank"))
    return chosen.select(*plain, F.col("rank").cast("bigint").alias("rank")).union(left)
