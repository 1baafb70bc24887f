"""File-stream ingest: the same staging and keyed merge as the batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.staging import stage_prices, standardise
from barloom.plans.refresh import newest_staged
from barloom.schemas import RAW, STAGED
from barloom.scratch import shuffles_removed
from barloom.sources.pointer import Folder
from barloom.sources.tables import KeyedTable


def price_stream(spark: SparkSession, landing: str, files_per_trigger: int = 1000) -> DataFrame:
    """Raw price files as a stream; sub-folders of the landing folder are followed."""
    return (
        spark.readStream.schema(RAW)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", "true")
        .parquet(landing)
    )


def ingest_available(stream: DataFrame, table: KeyedTable, checkpoint: str) -> None:
    """Merge everything that has landed since the last run into the staged table.

    The checkpoint is the cursor. Every batch stores its staged rows beside it under the number of
    the batch, and all of them are merged at once when the stream has ended, so that a bucket is
    written anew once a run and not once a batch. A batch that is replayed after a failure replaces
    its own rows; rows of a run that died before the merge are merged by the next one. Records
    arriving in any order end up the same, because the latest extraction wins.
    """
    spark, arrived = stream.sparkSession, f"{checkpoint}-arrived"

    def keep(batch: DataFrame, number: int) -> None:
        with shuffles_removed(batch.sparkSession):
            stage_prices(batch).write.mode("overwrite").parquet(f"{arrived}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    folder = Folder(spark, arrived)
    batches = folder.names()
    if batches:
        rows = spark.read.schema(STAGED).parquet(*[f"{arrived}/{name}" for name in batches])
        table.upsert(rows, merge=newest_staged, stored=True)
        for name in batches:
            folder.delete(name)


def first_seen(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming dedup by key: the first record wins, records behind the watermark are lost.

    State is dropped as the watermark passes, so it holds ``delay`` worth of keys.
    """
    timed = standardise(stream).withColumn("event_time", F.col("price_date").cast("timestamp"))
    return (
        timed.withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["symbol", "price_date"])
        .drop("event_time")
    )


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what has landed to a Parquet folder."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
