"""Keyed Parquet tables: partitioned by date, merged by rewriting only touched partitions.

A write never touches files that readers may have open. It puts new files for the buckets it
changes into a folder of its own, and then one small state file, which says in which folder
every bucket is, is replaced in one step. A run that dies in between leaves the table as it
was. The state also holds the newest day, so that a watermark costs no scan. Replaced files
stay until ``vacuum``.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import KEY, conform
from barloom.scratch import durable, passing, shuffles_removed
from barloom.sources.pointer import Folder, read_state, replace_state

UNDATED = "__HIVE_DEFAULT_PARTITION__"
# Files that one task keeps open, and bytes that each of them holds back until they are written.
OPEN_FILES = 16
ROW_GROUP = 32 << 20
GRAINS = ("day", "month", "year")


def merge_rows(stored: DataFrame, incoming: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Stored rows whose key is not among the incoming ones, plus all incoming rows.

    The last column of the key is a day, or anything else with an order. Only stored rows between
    the first and the last incoming day of their symbol can be replaced, so only they are joined
    by key; the others pass without a shuffle, as long as Spark broadcasts one row per incoming
    symbol. Where there are none, as when all incoming rows are newer, nothing is joined and the
    values of the stored rows are read once. Both keys are read more than once.
    """
    *group, day = key
    keys = incoming.select(*key)
    ranges = durable(
        keys.groupBy(*group).agg(F.min(day).alias("first_in"), F.max(day).alias("last_in"))
    )
    inside = F.coalesce(F.col(day).between(F.col("first_in"), F.col("last_in")), F.lit(False))
    if stored.select(*key).join(ranges, group).filter(inside).isEmpty():
        return stored.unionByName(incoming)
    ranged = stored.join(ranges, group, "left")
    apart = ranged.filter(~inside).select(*stored.columns)
    between = ranged.filter(inside).select(*stored.columns)
    kept = between.join(keys, list(key), "left_anti")
    return apart.unionByName(kept).unionByName(incoming)


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Tasks of the writes in this block keep a file of every year open, so rows need no sort.

    Spark sorts what comes after the first ``OPEN_FILES`` years of a task.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def watermark(df: DataFrame, column: str = "price_date") -> datetime.date | None:
    """Newest date of a table, fetched once so that it can be used as a literal."""
    return df.agg(F.max(column)).first()[0]


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet folder partitioned by day, month or year of ``date_column``.

    Pick the grain so that one partition is a reasonable unit of rewriting: ``day`` for
    very large tables with daily increments, ``month`` or ``year`` for small ones.
    """

    path: str
    schema: T.StructType
    date_column: str = "price_date"
    grain: str = "month"

    def bucket(self, day: Column) -> Column:
        if self.grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}, not {self.grain!r}")
        day = F.to_date(day)
        return day if self.grain == "day" else F.trunc(day, self.grain)

    def read(
        self,
        spark: SparkSession,
        since: datetime.date | None = None,
        before: datetime.date | None = None,
    ) -> DataFrame:
        """Rows of the table, of since <= date < before; other partitions are not opened."""
        limits = [self._bucket_of(spark, day) if day else None for day in (since, before)]
        buckets = self._state(spark)[1].get("buckets", {})
        rows = self._files(spark, self._within(buckets, *limits))
        if since is not None:
            rows = rows.filter(
                (F.col("bucket") >= self.bucket(F.lit(since)))
                & (F.col(self.date_column) >= F.lit(since))
            )
        if before is not None:
            rows = rows.filter(
                (F.col("bucket") <= self.bucket(F.lit(before)))
                & (F.col(self.date_column) < F.lit(before))
            )
        return rows.drop("bucket")

    def newest(self, spark: SparkSession) -> datetime.date | None:
        """Newest day of the table, as written down with its last change."""
        newest = self._state(spark)[1].get("newest")
        return newest and datetime.date.fromisoformat(newest)

    def replace(self, df: DataFrame, in_order: bool = False) -> None:
        """Full refresh.

        ``in_order`` says that the rows come in as many tasks as the files should be written by,
        each in the order of its symbols, as from windows by symbol: a table by year then takes
        them as they are, one file per task and year, without a shuffle of its own.
        """
        spark = df.sparkSession
        number, _ = self._state(spark)
        buckets, newest = self._write(conform(df, self.schema), in_order)
        self._commit(spark, number, {"buckets": buckets, "newest": newest})

    def upsert(
        self,
        df: DataFrame,
        merge: Callable[[DataFrame, DataFrame], DataFrame] = merge_rows,
        stored: bool = False,
    ) -> None:
        """Merge rows by key; the same rows merged twice leave the table unchanged.

        The increment is computed once and kept in the shared folder until it is merged, unless
        ``stored`` says that it is read from files already. Only the partitions of its buckets are
        read, merged and written anew; the rest stays where it is.
        """
        spark = df.sparkSession
        number, state = self._state(spark)
        dated = conform(df, self.schema).withColumn("bucket", self.bucket(F.col(self.date_column)))
        with nullcontext(dated) if stored else passing(dated) as incoming, shuffles_removed(spark):
            touched = {
                UNDATED if r.bucket is None else r.bucket.isoformat()
                for r in incoming.select("bucket").distinct().collect()
            }
            if not touched:
                return
            buckets = state.get("buckets", {})
            old = self._files(spark, {b: v for b, v in buckets.items() if b in touched})
            merged = merge(old.drop("bucket"), incoming.drop("bucket"))
            changed, newest = self._write(merged)
        kept = {b: v for b, v in buckets.items() if b not in touched}
        # The merge may drop rows of a bucket, but rows of the newest day only for newer ones.
        newest = max(filter(None, (state.get("newest"), newest)), default=None)
        self._commit(spark, number, {"buckets": kept | changed, "newest": newest})

    def clear(self, spark: SparkSession) -> None:
        """Take all rows out."""
        number, state = self._state(spark)
        if state.get("buckets"):
            self._commit(spark, number, {"buckets": {}, "newest": None})

    def vacuum(self, spark: SparkSession) -> None:
        """Delete files that no longer belong to the table. Nobody may be writing to it, nor
        still be reading a state it had before."""
        folder = Folder(spark, self.path)
        live = {(v, b) for b, v in self._state(spark)[1].get("buckets", {}).items()}
        for name in folder.names():
            if name.startswith("_fresh-"):
                folder.delete(name)
            if not name.startswith("version="):
                continue
            version = name.removeprefix("version=")
            if version not in {v for v, _ in live}:
                folder.delete(name)
                continue
            for part in folder.names(name):
                if part.startswith("bucket=") and (version, part.removeprefix("bucket=")) not in live:
                    folder.delete(f"{name}/{part}")

    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        return read_state(Folder(spark, self.path))

    def _commit(self, spark: SparkSession, number: int, state: dict) -> None:
        replace_state(Folder(spark, self.path), number, state)

    def _bucket_of(self, spark: SparkSession, day: datetime.date) -> str:
        if isinstance(day, datetime.datetime):
            day = day.date()
        first = {"day": day.day, "month": 1, "year": 1}[self.grain]
        return day.replace(day=first, month=1 if self.grain == "year" else day.month).isoformat()

    @staticmethod
    def _within(buckets: dict[str, str], low: str | None, high: str | None) -> dict[str, str]:
        """The buckets of a range; undated ones belong to no range."""
        if low is None and high is None:
            return buckets
        return {
            b: v
            for b, v in buckets.items()
            if b != UNDATED and (low is None or b >= low) and (high is None or b <= high)
        }

    def _files(self, spark: SparkSession, buckets: dict[str, str]) -> DataFrame:
        """Rows of the given buckets, with the column ``bucket``."""
        full = T.StructType(self.schema.fields + [T.StructField("bucket", T.DateType())])
        if not buckets:
            return spark.createDataFrame([], full)
        paths = [f"{self.path}/version={v}/bucket={b}" for b, v in sorted(buckets.items())]
        named = T.StructType(
            [*self.schema.fields, T.StructField("version", T.StringType()), full["bucket"]]
        )
        found = spark.read.schema(named).option("basePath", self.path).parquet(*paths)
        return found.drop("version")

    def _write(self, df: DataFrame, in_order: bool = False) -> tuple[dict[str, str], str | None]:
        """Write rows to a folder of their own; (bucket -> version, newest day)."""
        # Rebalancing splits a bucket that holds most rows into files of the advisory
        # size and packs small buckets together; sorting gives row groups narrow ranges.
        order = [c for c in ("symbol", self.date_column) if c in df.columns]
        version, seen = uuid.uuid4().hex, Observation()
        rows = df.observe(seen, F.max(F.to_date(self.date_column)).alias("newest")).withColumn(
            "bucket", self.bucket(F.col(self.date_column))
        )
        in_order = in_order and self.grain == "year"
        if not in_order:
            rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order)
        spark = df.sparkSession
        with shuffles_removed(spark), open_files(spark) if in_order else nullcontext():
            writer = rows.write.partitionBy("bucket")
            if in_order:
                writer = writer.option("parquet.block.size", ROW_GROUP)
            writer.parquet(f"{self.path}/version={version}")
        newest = seen.get["newest"]
        written = Folder(df.sparkSession, self.path).names(f"version={version}")
        buckets = {
            n.removeprefix("bucket="): version for n in written if n.startswith("bucket=")
        }
        return buckets, newest and newest.isoformat()


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int) -> None:
    """Store a relation bucketed by symbol: later windows by symbol need no shuffle."""
    (
        df.repartition(buckets, "symbol")
        .write.mode("overwrite")
        .bucketBy(buckets, "symbol")
        .sortBy("symbol", "price_date")
        .option("path", path)
        .saveAsTable(name)
    )
