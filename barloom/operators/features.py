"""Model features over the indicator table, in the same partitioning by symbol."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import (
    by_symbol,
    close,
    earlier,
    percent_change,
    ratio,
    rolling,
    stacked_extreme,
)
from barloom.schemas import FEATURES
from barloom.scratch import durable

# Look-back lengths in rows.
LAG_ROWS = (1, 3, 5, 7)
MOMENTUM_ROWS = (7, 14, 30)
RANGE_ROWS = (20, 50)
PART_ROWS = 10  # divides every number of RANGE_ROWS
SECTOR_RETURN_ROWS = (1, 3, 7)


def _with_earlier(bars: DataFrame, rows: Iterable[int]) -> DataFrame:
    """Adds each earlier close once, so that several expressions share one lag."""
    missing = [n for n in sorted(set(rows)) if f"close_{n}_ago" not in bars.columns]
    return bars.withColumns({f"close_{n}_ago": earlier(close(), n) for n in missing})


def _change_since(rows: int) -> Column:
    return percent_change(close(), F.col(f"close_{rows}_ago"))


def _lag_columns() -> dict[str, Column]:
    return {f"lag_{n}_day_return": _change_since(n) for n in LAG_ROWS}


def _momentum_columns() -> dict[str, Column]:
    columns = {f"momentum_{n}": _change_since(n) for n in MOMENTUM_ROWS}
    return {**columns, "momentum_1": close() - F.col("close_1_ago")}


def lag_returns(bars: DataFrame) -> DataFrame:
    added = _lag_columns()
    return _with_earlier(bars, LAG_ROWS).withColumns(added).select(*bars.columns, *added)


def previous_closes(bars: DataFrame) -> DataFrame:
    return bars.withColumns({f"prev_close_{n}": earlier(close(), n) for n in LAG_ROWS})


def momentum(bars: DataFrame) -> DataFrame:
    added = _momentum_columns()
    longer = _with_earlier(bars, (1, *MOMENTUM_ROWS))
    return longer.withColumns(added).select(*bars.columns, *added)


def average_crosses(indicators: DataFrame) -> DataFrame:
    """Days on which the 50-row average crosses the 200-row average, and the distances."""
    short, long = F.col("sma_50"), F.col("sma_200")
    prev_short, prev_long = F.col("prev_short"), F.col("prev_long")

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return (
        indicators.withColumns({"prev_short": earlier(short), "prev_long": earlier(long)})
        .withColumns(
            {
                "golden_cross_signal": flag((short > long) & (prev_short <= prev_long)),
                "death_cross_signal": flag((short < long) & (prev_short >= prev_long)),
                "ma_crossover_distance": short - long,
                "short_term_trend": F.col("sma_7") - F.col("sma_14"),
            }
        )
        .drop("prev_short", "prev_long")
    )


def support_resistance(bars: DataFrame) -> DataFrame:
    """Lowest low and highest high of the last rows, from extremes over a part of them."""
    pieces = {
        "low_part": rolling(F.min, "low_price", PART_ROWS),
        "high_part": rolling(F.max, "high_price", PART_ROWS),
    }
    columns: dict[str, Column] = {}
    for n in RANGE_ROWS:
        columns[f"support_{n}"] = stacked_extreme(F.least, "low_part", n, PART_ROWS)
        columns[f"resistance_{n}"] = stacked_extreme(F.greatest, "high_part", n, PART_ROWS)
    return bars.withColumns(pieces).withColumns(columns).drop(*pieces)


def price_position(ranged: DataFrame) -> DataFrame:
    """Place of the close within its support/resistance range; 0.5 in an empty range."""

    def place(n: int) -> Column:
        low, high = F.col(f"support_{n}"), F.col(f"resistance_{n}")
        return F.when(high - low == 0, F.lit(0.5)).otherwise(ratio(close() - low, high - low))

    return ranged.withColumns({f"price_position_{n}": place(n) for n in RANGE_ROWS})


def stable_sector(staged: DataFrame) -> DataFrame:
    """symbol, sector: the sector on the first day of the series."""
    return staged.groupBy("symbol").agg(F.min_by("sector", "price_date").alias("sector"))


def sector_momentum(bars: DataFrame) -> DataFrame:
    """Mean 1/3/7-row return of a sector on a day, attached to each of its symbols.

    ``bars`` needs symbol, sector, price_date and close_price. A window over (sector, day)
    would put a sector with a third of all symbols into single tasks, so the means are
    partially aggregated, stored once and joined back. Spark broadcasts them while they
    are small and otherwise shuffles; adaptive execution splits large sectors.
    """
    first_sector = F.first("sector").over(by_symbol()).alias("sector")
    returns = _with_earlier(bars, SECTOR_RETURN_ROWS).select(
        "symbol",
        "price_date",
        first_sector,
        *[_change_since(n).alias(f"return_{n}") for n in SECTOR_RETURN_ROWS],
    )
    means = durable(
        returns.groupBy(F.col("sector").alias("of_sector"), F.col("price_date").alias("of_day")).agg(
            *[F.avg(f"return_{n}").alias(f"sector_{n}_day_return") for n in SECTOR_RETURN_ROWS]
        )
    )
    members = bars.select("symbol", "price_date", first_sector)
    same = F.col("sector").eqNullSafe(F.col("of_sector")) & (F.col("price_date") == F.col("of_day"))
    return members.join(means, same).select(
        "symbol",
        "price_date",
        "sector",
        *[f"sector_{n}_day_return" for n in SECTOR_RETURN_ROWS],
    )


def ml_features(indicators: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """All 45 feature columns.

    Without ``staged`` the indicators must carry ``sector`` and nothing is joined. With
    ``staged`` the sector comes from one row per symbol, joined on the partitioning the
    indicators already have.
    """
    if staged is None:
        base = indicators.withColumn("sector", F.first("sector").over(by_symbol()))
    else:
        base = indicators.drop("sector").join(stable_sector(staged), "symbol", "left")
    lagged = _with_earlier(base, (*LAG_ROWS, *MOMENTUM_ROWS))
    moved = lagged.withColumns({**_lag_columns(), **_momentum_columns()})
    featured = price_position(support_resistance(average_crosses(moved)))
    return featured.select(*FEATURES.fieldNames())
