"""Staging: standardise raw prices and keep one record per symbol and day."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.schemas import STAGED


def standardise(raw: DataFrame) -> DataFrame:
    """Drop records without date, symbol or close; fix case and types of the key."""
    complete = (
        F.col("date").isNotNull() & F.col("symbol").isNotNull() & F.col("close_price").isNotNull()
    )
    return raw.filter(complete).select(
        F.to_date("date").alias("price_date"),
        F.upper("symbol").alias("symbol"),
        F.lower("sector").alias("sector"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        (F.col("high_price") - F.col("low_price")).alias("daily_range"),
        "extraction_timestamp",
    )


def latest_extraction(records: DataFrame) -> DataFrame:
    """One record per (symbol, price_date): the one extracted last.

    A maximum over structs combines on the map side, so any number of copies of one
    key leaves each task as one row. A missing timestamp sorts lowest; equal
    timestamps are settled by the remaining columns, so the result is repeatable.
    """
    rest = [c for c in records.columns if c not in ("symbol", "price_date", "extraction_timestamp")]
    best = records.groupBy("symbol", "price_date").agg(
        F.max(F.struct("extraction_timestamp", *rest)).alias("best")
    )
    return best.select("symbol", "price_date", "best.*").select(*records.columns)


def new_rows(df: DataFrame, watermark: datetime.date | None) -> DataFrame:
    """Rows after the watermark; the literal bound reaches the Parquet scan."""
    return df if watermark is None else df.filter(F.col("price_date") > F.lit(watermark))


def stage_prices(
    raw: DataFrame, watermark: datetime.date | None = None, late: str = "drop"
) -> DataFrame:
    """Raw prices to staged prices.

    ``late="drop"`` ignores records up to the watermark; ``late="merge"`` keeps them
    for a keyed upsert into the stored table.
    """
    if late not in ("drop", "merge"):
        raise ValueError(f"late must be 'drop' or 'merge', not {late!r}")
    records = standardise(raw)
    if late == "drop" and watermark is not None:
        next_day = F.lit(watermark + datetime.timedelta(days=1)).cast("timestamp_ntz")
        records = standardise(raw.filter(F.col("date") >= next_day))
    return latest_extraction(records).select(*STAGED.fieldNames())
