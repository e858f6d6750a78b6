"""CSV files turned into typed Parquet once, with the rows at fault set aside in the same pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.casting import typed
from ratelens.sources.readers import path_exists
from ratelens.sources.writers import finished, read_metadata, write_metadata

FAULT, RECORD = "ingest_fault", "ingest_record"
FAULTS = ("none", "short", "long", "unparsable")
#: Rows whose number of fields is right; values that do not parse are NULL in them.
KEPT = ("none", "unparsable")


def input_manifest(spark: SparkSession, paths: Iterable[str]) -> dict | None:
    """Number, bytes and digest of all files under ``paths``, by path, size and time of change; None if a path is missing.

    Files are listed by Spark, not read. The digest is a sum of hashes, the same in any order.
    """
    paths = list(paths)
    if not all(path_exists(spark, path) for path in paths):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    hashed = F.xxhash64("path", "length", F.col("modificationTime").cast("double")).cast("decimal(38,0)")
    row = files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.sum(hashed).alias("digest")).first()
    return {"files": row["files"], "bytes": row["bytes"], "digest": str(row["digest"])}


def _fields(record: Column) -> Column:
    """Fields of a CSV record: commas outside of quotes, and one more."""
    bare = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def judged_csv(spark: SparkSession, path: str, kinds: dict[str, str] | None = None, multi_line: bool = True) -> DataFrame:
    """Typed rows of a CSV with a header, with the kind of fault and the text of a row at fault.

    A row is short or long by its number of fields. It is unparsable if a field holds a text that is not of its kind.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RECORD]])
    raw = reader.schema(schema).option("columnNameOfCorruptRecord", RECORD).csv(path)
    kinds = kinds or {}
    values = {n: typed(F.col(f"`{n}`"), kinds.get(n, "string")) for n in names}
    lost = [F.col(f"`{n}`").isNotNull() & values[n].isNull() for n in names if kinds.get(n, "string") != "string"]
    unparsable = F.lit(False)
    for one in lost:
        unparsable = unparsable | one
    record = F.col(RECORD)
    fault = (
        F.when(record.isNotNull() & (_fields(record) < len(names)), "short")
        .when(record.isNotNull(), "long").when(unparsable, "unparsable").otherwise("none")
    )
    line = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]), {"escape": '"'})
    text = F.coalesce(record, F.when(unparsable, line))
    return raw.select(*[v.alias(n) for n, v in values.items()], text.alias(RECORD), fault.alias(FAULT))


def ingest_csv(
    spark: SparkSession, path: str, target: str, kinds: dict[str, str] | None = None, multi_line: bool = True
) -> DataFrame:
    """The typed rows of the CSV at ``path``, from the Parquet at ``target``, which is written if it isn't of that CSV.

    The CSV is parsed once, in one job, in which rows go to a folder by their fault.
    Short and long rows are left out here; ``quarantine`` has them, and rows with texts that do not parse.
    """
    done = f"{target}.finished"
    parameters = {"inputs": input_manifest(spark, [path]), "kinds": kinds or {}, "multi_line": multi_line}
    if not finished(spark, done, parameters):
        rows = judged_csv(spark, path, kinds, multi_line)
        rows.write.mode("overwrite").partitionBy(FAULT).parquet(target)
        columns = [[f.name, f.dataType.simpleString()] for f in rows.schema.fields if f.name not in (FAULT, RECORD)]
        # Folder names and file footers alone tell the counts. An Observation would too, but a session that has had one
        # can't apply a logistic model trained in it: the model holds the session, whose observations can't be sent.
        found = dict(_typed(spark, target, columns).groupBy(FAULT).count().collect())
        counts = {fault: found.get(fault, 0) for fault in FAULTS}
        write_metadata(spark, {"columns": columns, "counts": counts, "parameters": parameters}, done)
    return _stored(spark, target).filter(F.col(FAULT).isin(*KEPT)).drop(FAULT, RECORD)


def _stored(spark: SparkSession, target: str) -> DataFrame:
    return _typed(spark, target, read_metadata(spark, f"{target}.finished")["columns"])


def _typed(spark: SparkSession, target: str, columns: list[list[str]]) -> DataFrame:
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns)
    return spark.read.schema(f"{schema}, {RECORD} string, {FAULT} string").parquet(target)


def quarantine(spark: SparkSession, target: str) -> DataFrame:
    """``(ingest_fault, ingest_record)`` of the rows at fault, as they stand in the CSV."""
    return _stored(spark, target).filter(F.col(FAULT) != "none").select(FAULT, RECORD)


def ingest_counts(spark: SparkSession, target: str) -> dict[str, int]:
    """How many rows had each fault."""
    return read_metadata(spark, f"{target}.finished")["counts"]
