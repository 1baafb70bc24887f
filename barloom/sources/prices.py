"""Price scans, fetch windows, record normalisation and sector tagging."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import RAW

# Fetch windows in days, and the sector of unlisted symbols.
FULL_YEARS = 5
FIRST_DAYS = 30
OVERLAP_DAYS = 1
UNKNOWN_SECTOR = "unknown"
PRICE_FIELDS = {
    "Open": "open_price",
    "High": "high_price",
    "Low": "low_price",
    "Close": "close_price",
}
SCAN_COLUMNS = ["date", "symbol", "sector", *PRICE_FIELDS.values(), "volume"]

# Records as delivered: every field as text, so that a bad value reaches the reject table.
DELIVERED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("Date", "Symbol", *PRICE_FIELDS, "Volume")]
)


def read_raw(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(RAW).parquet(*paths)


def read_delivered(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines as delivered; an unreadable line becomes a row with ``_corrupt`` set."""
    schema = T.StructType(DELIVERED.fields + [T.StructField("_corrupt", T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(list(paths))
    )


def read_isolated(
    spark: SparkSession, schema: T.StructType, *paths: str, every_page: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows of the readable Parquet files, file, bytes and reason of the others).

    A file without a readable end, because it was cut off or is something else, is left out
    and reported; the other files are not affected. A file that has no rows is reported too.
    Damage inside a file shows only when its pages are read: ``every_page`` reads all of them
    once more and leaves a file out as a whole if it yields fewer rows than its end says.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
        )
    )
    rows = (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
    )
    file = F.col("_metadata.file_path").alias("file")
    # Counting without columns opens the ends of the files only.
    ends = rows.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    state = listed.join(ends, "file", "left")
    reason = F.when(F.col("n").isNull(), "no readable rows")
    if every_page:
        # Always true, but only known once every column of the row has been read.
        whole = F.xxhash64(*schema.fieldNames()) % 2 < 2
        read = rows.groupBy(file).agg(F.count_if(whole).alias("read"))
        state = state.join(read, "file", "left")
        damaged = F.coalesce("read", F.lit(0)) < F.col("n")
        reason = reason.when(damaged, "unreadable pages")
    rejected = state.withColumn("reason", reason).filter("reason is not null")
    if every_page:
        named = rows.withColumn("file", F.col("_metadata.file_path"))
        rows = named.join(rejected.select("file"), "file", "left_anti").select(*schema.fieldNames())
    return rows, rejected.select("file", "bytes", "reason")


def _midnight(day: datetime.date) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def price_scan(
    raw: DataFrame, as_of: datetime.date, days: int = 365, symbol: str | None = None
) -> DataFrame:
    """The last ``days`` days of prices, of one symbol or of all."""
    rows = raw.filter(F.col("date") >= _midnight(as_of - datetime.timedelta(days=days)))
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol)
    return rows.select(*SCAN_COLUMNS)


def training_scan(
    mart: DataFrame, as_of: datetime.date, days: int = 1095, symbol: str | None = None
) -> DataFrame:
    """The last ``days`` days of the training mart."""
    rows = mart.filter(F.col("price_date") >= F.lit(as_of - datetime.timedelta(days=days)))
    return rows if symbol is None else rows.filter(F.col("symbol") == symbol)


def fetch_start(
    cursor: datetime.date | None,
    now: datetime.date,
    override: datetime.date | None = None,
) -> datetime.date:
    """First day to fetch: the override, else the day before the cursor, else 30 days ago."""
    if override is not None:
        return override
    if cursor is not None:
        return cursor - datetime.timedelta(days=OVERLAP_DAYS)
    return now - datetime.timedelta(days=FIRST_DAYS)


def fetch(source: DataFrame, start: datetime.date, end: datetime.date) -> DataFrame:
    """Records with start <= date < end."""
    return source.filter((F.col("date") >= _midnight(start)) & (F.col("date") < _midnight(end)))


def full_history(source: DataFrame, now: datetime.date, years: int = FULL_YEARS) -> DataFrame:
    """Records of a full refresh."""
    return fetch(source, now - datetime.timedelta(days=365 * years), now)


def latest_record(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Merge rule of the raw table: the latest extraction per (date, symbol) wins.

    A record without date has no key to be replaced by: its key is the whole record, so
    only equal ones are merged.
    """
    union = stored.unionByName(incoming)
    rest = [c for c in union.columns if c not in ("date", "symbol", "extraction_timestamp")]
    undated = F.when(F.col("date").isNull(), F.struct("extraction_timestamp", *rest))
    best = union.groupBy("date", "symbol", undated.alias("undated")).agg(
        F.max(F.struct("extraction_timestamp", *rest)).alias("best")
    )
    return best.select("date", "symbol", "best.*").select(*union.columns)


def sector_dim(spark: SparkSession, sectors: Mapping[str, Sequence[str]]) -> DataFrame:
    """symbol, sector: the configured lists, flattened."""
    config = spark.createDataFrame(
        [({k: list(v) for k, v in sectors.items()},)], "sectors map<string,array<string>>"
    )
    return config.select(F.explode("sectors").alias("sector", "symbols")).select(
        F.explode("symbols").alias("symbol"), "sector"
    )


def tag_sector(records: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds ``sector`` by symbol, ``unknown`` where the symbol is not listed.

    No hint: Spark broadcasts the dimension only while it knows it to be small.
    """
    tagged = records.drop("sector").join(dim.select("symbol", "sector"), "symbol", "left")
    return tagged.withColumn("sector", F.coalesce("sector", F.lit(UNKNOWN_SECTOR)))


def _wall_clock(text: Column) -> Column:
    """Timestamp text without its zone: the clock reading is kept, not shifted."""
    return F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")


def _parsed(delivered: DataFrame) -> DataFrame:
    # Volumes may arrive as decimals ("1200.0"); they are counted in whole shares.
    values = {new: F.col(old).try_cast("double") for old, new in PRICE_FIELDS.items()}
    values["volume"] = F.col("Volume").try_cast("double").try_cast("bigint")
    corrupt = F.col("_corrupt") if "_corrupt" in delivered.columns else F.lit(None)
    reason = F.when(corrupt.isNotNull(), "unreadable record")
    reason = reason.when(F.col("symbol").isNull(), "missing symbol")
    reason = reason.when(F.col("date").isNull(), "invalid date")
    for name in values:
        reason = reason.when(F.col(name).isNull(), f"invalid {name}")
    original = [F.col(n).alias(f"delivered_{n.lower()}") for n in DELIVERED.fieldNames()]
    parsed = delivered.select(
        *original,
        *([F.col("_corrupt")] if "_corrupt" in delivered.columns else []),
        _wall_clock(F.col("Date")).alias("date"),
        F.col("Symbol").alias("symbol"),
        *[v.alias(k) for k, v in values.items()],
    )
    return parsed.withColumn("reason", reason)


def normalise(delivered: DataFrame, dim: DataFrame, extracted_at: str) -> DataFrame:
    """Valid delivered records in the raw schema; bad ones do not stop the others."""
    valid = _parsed(delivered).filter(F.col("reason").isNull())
    tagged = tag_sector(valid.select("date", "symbol", *PRICE_FIELDS.values(), "volume"), dim)
    stamped = tagged.withColumn("extraction_timestamp", F.lit(extracted_at))
    return stamped.select(*RAW.fieldNames())


def rejects(delivered: DataFrame) -> DataFrame:
    """Records that ``normalise`` leaves out, as delivered, with the reason."""
    bad = _parsed(delivered).filter(F.col("reason").isNotNull())
    return bad.select(*[c for c in bad.columns if c.startswith("delivered_")], "reason")


def dataset_info(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.countDistinct("symbol").alias("symbols"),
    )
