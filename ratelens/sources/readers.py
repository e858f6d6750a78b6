"""Typed CSV and Parquet inputs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.casting import typed
from ratelens.operators.star import STAR_SCHEMAS, Star


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can resolve the path; no job is run."""
    try:
        spark.read.text([path, path])  # a single path would also be probed for a streaming log, with a warning
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail with the list of all missing inputs."""
    missing = [path for path in paths if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def with_standard_names(df: DataFrame, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """Columns under their standard names, found by that name or an alias, whatever their case.

    Earlier aliases go before later ones. Standard names without a column, and columns that two standard names
    lay claim to, are reported together.
    """
    wanted: dict[str, list[tuple[int, str]]] = {}
    for standard, others in aliases.items():
        for place, alias in enumerate((standard, *others)):
            wanted.setdefault(alias.lower(), []).append((place, standard))
    found: dict[str, tuple[int, str]] = {}
    for field in df.schema.fields:
        for place, standard in wanted.get(field.name.lower(), ()):
            found[standard] = min(found.get(standard, (place, field.name)), (place, field.name))
    owners: dict[str, list[str]] = {}
    for standard, (_, column) in found.items():
        owners.setdefault(column, []).append(standard)
    faults = [f"{name}: no column" for name in aliases if name not in found]
    faults += [f"{column}: taken for {' and '.join(names)}" for column, names in owners.items() if len(names) > 1]
    if faults:
        raise ValueError("; ".join(faults) + f" (columns: {df.columns})")
    return df.withColumnsRenamed({column: names[0] for column, names in owners.items()})


def read_csv(
    spark: SparkSession,
    path: str,
    kinds: dict[str, str] | None = None,
    multi_line: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header: columns are found by name, typed by ``kinds`` and text otherwise.

    Quoted fields may hold commas, doubled quotes and, with ``multi_line``, line breaks; such files are
    read by one task each, so large files without line breaks in fields should be read with
    ``multi_line=False``. Values that do not parse become NULL; ``corrupt_column`` keeps the text of
    rows with too few or too many fields.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    raw = reader.csv(path)
    names = raw.columns
    if corrupt_column:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, corrupt_column]])
        raw = reader.schema(schema).option("columnNameOfCorruptRecord", corrupt_column).csv(path)
    kinds = kinds or {}
    columns = [typed(F.col(f"`{n}`"), kinds.get(n, "string")).alias(n) for n in names]
    return raw.select(*columns, *([F.col(corrupt_column)] if corrupt_column else []))


def load_star(spark: SparkSession, path: str) -> Star:
    """The four star tables written by ``save_star``, with their declared schemas."""
    return Star(*[spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in STAR_SCHEMAS.items()])


def load_split(
    spark: SparkSession, path: str, split: str, kinds: dict[str, str] | None = None, prefer_parquet: bool = True
) -> DataFrame:
    """One split from ``<split>.parquet`` or ``<split>.csv``, in the preferred order; an error without either."""
    readers = [("parquet", lambda p: spark.read.parquet(p)), ("csv", lambda p: read_csv(spark, p, kinds))]
    for suffix, read in readers if prefer_parquet else readers[::-1]:
        file = f"{path}/{split}.{suffix}"
        if path_exists(spark, file):
            return read(file)
    raise FileNotFoundError(f"neither {path}/{split}.parquet nor {path}/{split}.csv")


def ratings_of_known_users(ratings: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Ratings of the given users by a semi join; an error when there are none."""
    kept = ratings.join(users.select(key), key, "left_semi")
    if kept.isEmpty():
        raise ValueError("no rating belongs to the given users")
    return kept
