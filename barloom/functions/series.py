"""Window frames over one symbol's bars, and guarded arithmetic.

A symbol has at most one bar per calendar day (staging enforces the key), so a
window partition never holds more than the number of days in the history: about
25,000 rows for a century of trading days, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def close() -> Column:
    return F.col("close_price")


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("price_date")


def trailing(rows: int) -> WindowSpec:
    return by_symbol().rowsBetween(1 - rows, Window.currentRow)


def running() -> WindowSpec:
    return by_symbol().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rolling(
    fn: Callable[[Column], Column], value: Column | str, rows: int, min_rows: int = 1
) -> Column:
    """``fn`` over the last ``rows`` rows; NULL until ``min_rows`` values are there."""
    value = F.col(value) if isinstance(value, str) else value
    result = fn(value).over(trailing(rows))
    if min_rows > 1:
        result = F.when(F.count(value).over(trailing(rows)) >= min_rows, result)
    return result


def short_sums(value: Column, rows: int, name: str) -> dict[str, Column]:
    """Sum and count over the last ``rows`` rows, 0 without values, for ``stacked_sums``."""
    return {
        f"{name}_sum_{rows}": F.coalesce(rolling(F.sum, value.cast("double"), rows), F.lit(0.0)),
        f"{name}_count_{rows}": rolling(F.count, value, rows),
    }


def stacked_sums(rows: int, piece: int, name: str) -> dict[str, Column]:
    """Sum and count over ``rows`` rows from those over ``piece`` rows, oldest first.

    A moving frame adds up all its rows again for every row; a lag reads one. Rows before
    the series add nothing, so a longer sum equals the shorter one while it has the same rows.
    """

    def stack(part: str, none: Column) -> Column:
        column = f"{name}_{part}_{piece}"
        before = [F.coalesce(earlier(column, k), none) for k in range(rows - piece, 0, -piece)]
        return reduce(add, [*before, F.col(column)])

    return {
        f"{name}_sum_{rows}": stack("sum", F.lit(0.0)),
        f"{name}_count_{rows}": stack("count", F.lit(0).cast("bigint")),
    }


def stacked_mean(rows: int, name: str) -> Column:
    return ratio(F.col(f"{name}_sum_{rows}"), F.col(f"{name}_count_{rows}"))


def stacked_extreme(
    pick: Callable[..., Column], column: str, rows: int, piece: int
) -> Column:
    """``F.least`` or ``F.greatest`` over ``rows`` rows from the extremes over ``piece`` rows."""
    return pick(column, *[earlier(column, k) for k in range(piece, rows, piece)])


def earlier(value: Column | str, rows: int = 1) -> Column:
    return F.lag(value, rows).over(by_symbol())


def later(value: Column | str, rows: int = 1) -> Column:
    return F.lead(value, rows).over(by_symbol())


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def percent_change(now: Column, base: Column) -> Column:
    return ratio(now - base, base) * 100


def rise(change: Column) -> Column:
    return F.when(change > 0, change).otherwise(0.0)


def fall(change: Column) -> Column:
    return F.when(change < 0, F.abs(change)).otherwise(0.0)


def signed_volume(price: Column, prev_price: Column, volume: Column) -> Column:
    """Volume with the sign of the price move; zero on the first bar and on no move."""
    return (
        F.when(price > prev_price, volume)
        .when(price < prev_price, -volume)
        .otherwise(F.lit(0).cast("bigint"))
    )


def true_range(high: Column, low: Column, reference_close: Column) -> Column:
    return F.greatest(high - low, F.abs(high - reference_close), F.abs(low - reference_close))
