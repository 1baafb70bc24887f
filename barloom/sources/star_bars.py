"""Daily bars derived from the star-schema test tables.

One symbol per supplier, sector = region of the supplier. Lines are aggregated per
(supplier, day) before any join, so partial aggregation absorbs a supplier that
holds a large share of the lines, and the joins only see finished bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OHLCV = ["open_price", "high_price", "low_price", "close_price", "volume"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def symbol_of(supplier: str) -> Column:
    return F.concat(F.lit("S"), F.col(supplier).cast("string"))


def star_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, sector, price_date, open/high/low/close_price, volume."""
    price = F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("price_date"),
        F.struct("l_orderkey", "l_linenumber", price.alias("price")).alias("line"),
        "l_quantity",
    )
    bars = lines.groupBy("l_suppkey", "price_date").agg(
        F.min("line").getField("price").alias("open_price"),
        F.max(F.col("line.price")).alias("high_price"),
        F.min(F.col("line.price")).alias("low_price"),
        F.max("line").getField("price").alias("close_price"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )
    symbols = table(spark, sf_dir, "supplier").select(
        symbol_of("s_suppkey").alias("symbol"), "s_nationkey"
    )
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    # One dimension after the other: Spark knows the size of each, but not of their join, for
    # which it would shuffle the bars. Where the suppliers are many the bars are joined on the
    # symbol itself, and windows by symbol reuse that partitioning.
    return (
        bars.withColumn("symbol", symbol_of("l_suppkey"))
        .join(symbols, "symbol")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("sector", F.lower("r_name"))
        .select("symbol", "sector", "price_date", *OHLCV)
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price records as an extractor would leave them, with its usual dirt.

    Every bar appears once; in addition there are stale duplicates (15th of the
    month), corrections (16th), records without a close (20th, europe) and records
    without a date (21st, america). Symbols of africa and asia are in lower case.
    One pass over the bars: each bar emits its own one to three records.
    """
    day = F.dayofmonth("price_date")
    stamp = F.col("price_date").cast("timestamp_ntz")
    symbol = F.when(F.col("sector").isin("africa", "asia"), F.lower("symbol")).otherwise(
        F.col("symbol")
    )

    def record(extracted, keep=None, date=stamp, bump=0.0, close=None):
        fields = F.struct(
            date.alias("date"),
            symbol.alias("symbol"),
            F.upper("sector").alias("sector"),
            F.col("open_price"),
            (F.col("high_price") + bump).alias("high_price"),
            F.col("low_price"),
            ((F.col("close_price") if close is None else close) + bump).alias("close_price"),
            F.col("volume"),
            F.lit(extracted).alias("extraction_timestamp"),
        )
        return fields if keep is None else F.when(keep, fields)

    no_close = F.lit(None).cast("double")
    no_date = F.lit(None).cast("timestamp_ntz")
    records = F.array(
        record("2002-01-02T00:00:00"),
        record("2002-01-01T00:00:00", keep=day == 15, bump=1.0),
        record("2002-01-03T00:00:00", keep=day == 16, bump=1.0),
        record("2002-01-04T00:00:00", (day == 20) & (F.col("sector") == "europe"), close=no_close),
        record("2002-01-04T00:00:00", (day == 21) & (F.col("sector") == "america"), date=no_date),
    )
    return star_bars(spark, sf_dir).select(F.inline(F.array_compact(records)))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the event stream, one symbol per event type.

    Few symbols and many ticks: the first and last tick of a day come from partially
    aggregated structs, never from a list of the day's ticks.
    """
    tick = F.struct("ts", "event_id", "value")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("price_date"))
        .agg(
            F.min(tick).getField("value").alias("open_price"),
            F.max("value").alias("high_price"),
            F.min("value").alias("low_price"),
            F.max(tick).getField("value").alias("close_price"),
            F.count(F.lit(1)).alias("volume"),
        )
        .withColumn("sector", F.lit("unknown"))
    )
