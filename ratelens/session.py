"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "ratelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the few settings the library counts on; everything else is deployment."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def raise_if_stopped(spark: SparkSession) -> None:
    """Within a handler of errors: pass the error on if the application has ended, as then it isn't one of a query."""
    if spark.sparkContext._jsc.sc().isStopped():
        raise


def side_by_side(spark: SparkSession, *calls: Callable[[], Any]) -> list:
    """Results of calls run in threads, with the caller's job tags, so that jobs fill the cores that others' last tasks leave idle."""
    with ThreadPoolExecutor(len(calls)) as threads:
        running = [threads.submit(inheritable_thread_target(spark)(call)) for call in calls]
        return [call.result() for call in running]


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not shared:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="ratelens-")
        shared = _local_scratch[context.applicationId]
    return f"{shared.rstrip('/')}/ratelens/{context.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediate tables; results that still read them must be stored before."""
    jvm, context = spark._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one intermediate table."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: one computation, no lineage, pruned reads."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
