"""Exact deduplication as a stream with disk-backed keyed state.

The stream aggregates by digest of the normalised text without expiry: its state keeps,
for every digest ever seen, the smallest identifier with the place of that row (file and
row number) and the number of rows. The state lives in RocksDB and its checkpoints in the
shared folder, so a restarted stream or a replaced executor goes on from the last batch.
Copies are combined before the shuffle, so a text that a third of all rows share reaches
the state as one row a task.

Rows whose digest occurs more than once are then compared by their full bytes. Should two
different texts ever share a digest, they are told apart by text.

Defined results: a null text counts as empty. Of equal texts the row with the smallest
identifier stays; among repeated rows of one identifier the first by file and row number.
An empty table gives an empty result.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import durable
from barloom.scratch import fresh_path

SPACES = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 64 << 30
PLACE = ["doc_id", "file", "row"]
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def located(source: DataFrame) -> DataFrame:
    """doc_id, file, row and normalised text of rows read from Parquet files."""
    return source.select(
        "doc_id",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        normalised().alias("text"),
    )


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


@contextmanager
def state_store(spark: SparkSession):
    """RocksDB as state store for streams started inside."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stream_state(source: DataFrame, folder: str) -> DataFrame:
    """digest, keep (doc_id, file, row), n: the state after all files seen so far.

    ``source`` is a file stream and ``folder`` belongs to it: called again after more files
    have arrived, only those are read. Each batch writes its changed entries; the newest
    entry of a digest counts, and a batch that is repeated replaces its own entries.
    """
    spark = source.sparkSession
    entries = (
        located(source)
        .select(_digest().alias("digest"), F.struct(*PLACE).alias("place"))
        .groupBy("digest")
        .agg(F.min("place").alias("keep"), F.count(F.lit(1)).alias("n"))
    )

    def changed(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/entries/batch={number}")

    with state_store(spark):
        query = (
            entries.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(changed)
            .start()
        )
        query.awaitTermination()
    place = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("file", T.StringType()),
         T.StructField("row", T.LongType())]
    )
    schema = T.StructType(
        [T.StructField("digest", T.BinaryType()), T.StructField("keep", place),
         T.StructField("n", T.LongType()), T.StructField("batch", T.LongType())]
    )
    if not query.recentProgress and not _has_entries(spark, folder):
        return spark.createDataFrame([], schema).drop("batch")
    stored = spark.read.schema(schema).parquet(f"{folder}/entries")
    return stored.groupBy("digest").agg(
        F.max_by("keep", "batch").alias("keep"), F.max_by("n", "batch").alias("n")
    )


def _has_entries(spark: SparkSession, folder: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(f"{folder}/entries")
    except AnalysisException:
        return False
    return True


def exact_dedup(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """One row for every row of the Parquet files below ``path``: doc_id, keep_id,
    group_size, kept and the digest of the normalised text."""
    folder = folder or fresh_path(spark, "exact-dedup")
    batch = spark.read.parquet(path)
    # As a pattern, the path may be a single file as well as a folder.
    parent, _, name = path.rstrip("/").rpartition("/")
    source = (
        spark.readStream.schema(batch.schema)
        .option("maxBytesPerTrigger", BATCH_BYTES)
        .parquet(f"{parent}/{{{name}}}")
    )
    state = stream_state(source, folder)
    rows = located(batch).select(*PLACE, _digest().alias("digest"))
    # Only the join by digest can be uneven; adaptive execution splits the large side.
    marked = durable(rows.join(state, "digest").select(*PLACE, "digest", "keep", "n"))
    return _told_apart(batch, marked).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.struct(*PLACE) == F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _told_apart(batch: DataFrame, marked: DataFrame) -> DataFrame:
    """``marked`` after the bytes of all hits have been compared."""
    hits = marked.filter("n > 1").select("file", "row", "digest")
    texts = located(batch).join(hits, ["file", "row"])
    groups = texts.groupBy("digest", "text").agg(
        F.min(F.struct(*PLACE)).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    per_digest = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
    shared = durable(per_digest.filter("texts > 1").select("digest"))
    if shared.isEmpty():
        return marked
    doubtful = marked.join(shared, "digest", "left_semi").select(*PLACE, "digest")
    again = located(batch).select("file", "row", "text").join(doubtful, ["file", "row"])
    parted = again.groupBy("digest", "text").agg(
        F.min(F.struct(*PLACE)).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    fixed = again.join(parted, ["digest", "text"]).select(*PLACE, "digest", "keep", "n")
    return marked.join(shared, "digest", "left_anti").unionByName(fixed)
