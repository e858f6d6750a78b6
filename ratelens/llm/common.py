"""Small helpers of the operators: tables, words, stored intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelens.session import stored

#: Fixed value: a word is a run of bytes other than the space and U+0009 to U+000D; ``bytes.split()`` cuts there.
WORD = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the named columns, under fixed names ``id`` and ``text``; a null text is empty."""
    return df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *[F.col(f"`{name}`") for name in more],
    )


def row_keys(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the key of a row: its id and the digest of its text, so that a repeated id is no clash."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.withColumns({"__id": F.col(f"`{id_col}`"), "__digest": F.md5(F.encode(text, "utf-8"))})


def one_per_key(keyed: DataFrame) -> DataFrame:
    """One row of each key of ``row_keys``; each task keeps one of its own before the shuffle."""
    once = Window.partitionBy("__id", "__digest").orderBy("__digest")
    return keyed.withColumn("__nth", F.row_number().over(once)).filter("__nth = 1").drop("__nth")


def slices(batch: pa.RecordBatch, text_col: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``limit`` bytes of text, at least one row each.

    An Arrow batch may hold 64 MB of text, of which lists of words would be many times as large.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(lengths.astype(np.int64)) // limit
    cuts = [0, *(np.nonzero(np.diff(run))[0] + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema, text_col: str = "text"
) -> DataFrame:
    """``function`` over slices of the Arrow batches of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield function(part)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(name).to_pylist()


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, with its columns in order."""
    return stored(df, label).select(*[f"`{c}`" for c in df.columns])


def lower_ascii(data: bytes) -> bytes:
    """A-Z lower-cased, everything else as it is."""
    return data.lower()  # bytes.lower() changes ASCII letters only
