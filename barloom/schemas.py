"""Column contracts of the stored relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = ["symbol", "price_date"]


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, dtype, True) for dtype, names in groups for name in names.split()]
    )


RAW = _struct(
    (T.TimestampNTZType(), "date"),
    (T.StringType(), "symbol sector"),
    (T.DoubleType(), "open_price high_price low_price close_price"),
    (T.LongType(), "volume"),
    (T.StringType(), "extraction_timestamp"),
)

STAGED = _struct(
    (T.DateType(), "price_date"),
    (T.StringType(), "symbol sector"),
    (T.DoubleType(), "open_price high_price low_price close_price"),
    (T.LongType(), "volume"),
    (T.DoubleType(), "daily_range"),
    (T.StringType(), "extraction_timestamp"),
)

INDICATORS = _struct(
    (T.StringType(), "symbol"),
    (T.DateType(), "price_date"),
    (T.DoubleType(), "open_price high_price low_price close_price"),
    (T.LongType(), "volume"),
    (T.DoubleType(), "daily_range sma_7 sma_14 sma_30 sma_50 sma_200 rsi_14"),
    (T.DoubleType(), "macd_line macd_signal macd_histogram"),
    (T.DoubleType(), "bb_middle bb_upper bb_lower bb_position atr_14 volume_sma_20"),
    (T.LongType(), "obv"),
    (T.DoubleType(), "volume_ratio volatility_20"),
)

_FEATURE_PART = _struct(
    (T.DoubleType(), "lag_1_day_return lag_3_day_return lag_5_day_return lag_7_day_return"),
    (T.DoubleType(), "momentum_7 momentum_14 momentum_30 momentum_1"),
    (T.IntegerType(), "golden_cross_signal death_cross_signal"),
    (T.DoubleType(), "ma_crossover_distance short_term_trend"),
    (T.DoubleType(), "support_20 resistance_20 support_50 resistance_50"),
    (T.DoubleType(), "price_position_20 price_position_50"),
)

FEATURES = T.StructType(
    INDICATORS.fields + _FEATURE_PART.fields + [T.StructField("sector", T.StringType(), True)]
)

MART = T.StructType(
    INDICATORS.fields
    + _FEATURE_PART.fields
    + _struct(
        (T.IntegerType(), "sector_code"),
        (T.DoubleType(), "next_day_return next_week_return next_month_return"),
        (T.StringType(), "split"),
        (T.IntegerType(), "fold_number"),
    ).fields
)


class SchemaDrift(ValueError):
    """Raised before a write whose columns differ from the declared relation."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Put columns in declared order; raise on a missing, extra or retyped column."""
    want = {f.name: f.dataType for f in schema.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing {n}" for n in want if n not in have]
    problems += [f"unexpected {n}" for n in have if n not in want]
    problems += [
        f"{n} is {have[n].simpleString()}, declared {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    if problems:
        raise SchemaDrift("; ".join(problems))
    return df.select(*want)
