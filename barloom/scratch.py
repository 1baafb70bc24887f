"""Reliable materialisation in the folder the cluster shares.

``spark.checkpoint.dir`` names that folder. Only a local session may fall back
to a temporary folder of its own; on a cluster an unset folder is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from barloom.sources.pointer import Folder

_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="barloom-")
    return _local_folder[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never handed out twice."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in this block go as soon as each write has ended.

    What was written replaces them; otherwise a chain of stored steps keeps the shuffles of
    all its steps on the disks of the executors.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _stored(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back.

    They survive a lost executor, are computed once, and later reads still prune columns
    and push filters down.
    """
    return _stored(df, fresh_path(df.sparkSession, "durable"))


@contextmanager
def passing(df: DataFrame) -> Iterator[DataFrame]:
    """``durable`` rows that are deleted when the block ends; nothing may read them later."""
    path = fresh_path(df.sparkSession, "passing")
    try:
        yield _stored(df, path)
    finally:
        Folder(df.sparkSession, path).delete("")
