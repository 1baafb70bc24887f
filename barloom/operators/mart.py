"""Labelled training mart: targets, date split, folds, sector codes, completeness filter."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import close, later, percent_change
from barloom.schemas import MART

# Horizons in rows, key features, default cut-offs and codes.
TARGET_ROWS = {"next_day_return": 1, "next_week_return": 5, "next_month_return": 21}
REQUIRED = [
    "next_day_return", "next_week_return",
    "sma_7", "sma_14", "sma_30", "sma_50", "sma_200",
    "rsi_14", "macd_line", "bb_position", "atr_14", "volatility_20",
]


@dataclass(frozen=True)
class MartSettings:
    validation_from: datetime.date = datetime.date(2024, 1, 1)
    test_from: datetime.date = datetime.date(2025, 1, 1)
    fold_years: Sequence[int] = (2021, 2022, 2023, 2024, 2025)
    sector_codes: Mapping[str, int] = field(
        default_factory=lambda: {"gold": 1, "oil": 2, "silver": 3}
    )


def targets(bars: DataFrame) -> DataFrame:
    ahead = {f"close_in_{n}": later(close(), n) for n in TARGET_ROWS.values()}
    returns = {
        name: percent_change(F.col(f"close_in_{n}"), close()) for name, n in TARGET_ROWS.items()
    }
    return bars.withColumns(ahead).withColumns(returns).drop(*ahead)


def split_label(settings: MartSettings) -> Column:
    day = F.col("price_date")
    return (
        F.when(day < F.lit(settings.validation_from), "train")
        .when(day < F.lit(settings.test_from), "validation")
        .otherwise("test")
    )


def fold_number(settings: MartSettings) -> Column:
    """Number of listed years begun: 0 before them, 1 … k by their order.

    A year that is not listed belongs to the fold before it; the last fold is open-ended.
    """
    year = F.year("price_date")
    begun = [(year >= y).cast("int") for y in sorted(set(settings.fold_years))]
    return sum(begun, F.lit(0)).cast("int")


def sector_code(settings: MartSettings) -> Column:
    code = F.lit(0)
    for sector, number in settings.sector_codes.items():
        code = F.when(F.col("sector") == sector, number).otherwise(code)
    return code


def label(features: DataFrame, settings: MartSettings = MartSettings()) -> DataFrame:
    """Targets, split, fold and code on every feature row, before the filter."""
    return targets(features).withColumns(
        {
            "split": split_label(settings),
            "fold_number": fold_number(settings),
            "sector_code": sector_code(settings),
        }
    )


def training_mart(features: DataFrame, settings: MartSettings = MartSettings()) -> DataFrame:
    return label(features, settings).dropna(subset=REQUIRED).select(*MART.fieldNames())
