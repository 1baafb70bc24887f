"""Technical indicators of the warehouse models.

Frames are partial at the start of a series. All indicators share one partitioning
and order, so Spark plans one shuffle and one sort by symbol, and one Window node per
dependency layer: first what rests on prices, then what rests on those columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import (
    close,
    earlier,
    fall,
    ratio,
    rise,
    rolling,
    running,
    short_sums,
    signed_volume,
    stacked_mean,
    stacked_sums,
    true_range,
)
from barloom.schemas import INDICATORS

# Window lengths in rows.
SMA_ROWS = (7, 14, 30, 50, 200)
RSI_ROWS = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BAND_ROWS, BAND_WIDTH = 20, 2
ATR_ROWS = 14
VOLUME_ROWS = 20
VOLATILITY_ROWS = 20
# Averages of more rows than twice this are put together from sums over this many.
PIECE_ROWS = 10


def price_change(bars: DataFrame) -> DataFrame:
    return bars.withColumns(
        {
            "price_change": close() - earlier(close()),
            "intraday_return": close() - F.col("open_price"),
        }
    )


def stacking(rows: Sequence[int]) -> list[dict[int, int]]:
    """Layers of (rows of an average: rows of the sums it is put together from)."""
    layers: list[dict[int, int]] = []
    level = {PIECE_ROWS: 0}
    for n in sorted(set(rows)):
        fitting = [m for m in level if n % m == 0]
        if n > 2 * PIECE_ROWS and fitting:
            piece = max(fitting)
            level[n] = level[piece] + 1
            layers += [{} for _ in range(level[n] - len(layers))]
            layers[level[n] - 1][n] = piece
    return layers


def _direct_averages(rows: Sequence[int]) -> dict[str, Column]:
    """The averages with frames of their own, and the sums that the others are made of."""
    layers = stacking(rows)
    direct = [n for n in rows if not any(n in layer for layer in layers)]
    averages = {f"sma_{n}": rolling(F.avg, close(), n) for n in direct}
    return {**averages, **(short_sums(close(), PIECE_ROWS, "close") if layers else {})}


def _stacked_sums(layer: dict[int, int]) -> dict[str, Column]:
    found: dict[str, Column] = {}
    for n, piece in layer.items():
        found |= stacked_sums(n, piece, "close")
    return found


def _stacked_averages(layer: dict[int, int]) -> dict[str, Column]:
    return {f"sma_{n}": stacked_mean(n, "close") for n in layer}


def moving_averages(bars: DataFrame, rows: Sequence[int] = SMA_ROWS) -> DataFrame:
    averaged = bars.withColumns(_direct_averages(rows))
    for layer in stacking(rows):
        averaged = averaged.withColumns(_stacked_sums(layer))
        averaged = averaged.withColumns(_stacked_averages(layer))
    return averaged.select(*bars.columns, *[f"sma_{n}" for n in rows])


def gain_loss(bars: DataFrame) -> DataFrame:
    change = close() - earlier(close())
    return bars.withColumns({"gain": rise(change), "loss": fall(change)})


def strength_index(avg_gain: Column, avg_loss: Column) -> Column:
    """RSI from mean gain and loss; 100 when there was no loss at all."""
    return F.when(avg_loss == 0, F.lit(100.0)).otherwise(
        100 - 100 / (1 + ratio(avg_gain, avg_loss))
    )


def rsi(bars: DataFrame, rows: int = RSI_ROWS) -> DataFrame:
    return (
        gain_loss(bars)
        .withColumn(
            f"rsi_{rows}",
            strength_index(rolling(F.avg, "gain", rows), rolling(F.avg, "loss", rows)),
        )
        .drop("gain", "loss")
    )


def macd_sma(bars: DataFrame) -> DataFrame:
    """MACD with plain moving averages of 12, 26 and 9 rows."""
    line = rolling(F.avg, close(), MACD_FAST) - rolling(F.avg, close(), MACD_SLOW)
    return (
        bars.withColumn("macd_line", line)
        .withColumn("macd_signal", rolling(F.avg, "macd_line", MACD_SIGNAL))
        .withColumn("macd_histogram", F.col("macd_line") - F.col("macd_signal"))
    )


def band_position(price: Column, lower: Column, upper: Column) -> Column:
    """Place of the close between the bands; 0 when they coincide, NULL when unknown."""
    return F.when(upper - lower == 0, F.lit(0.0)).otherwise(ratio(price - lower, upper - lower))


def bollinger(bars: DataFrame) -> DataFrame:
    spread = BAND_WIDTH * rolling(F.stddev_samp, close(), BAND_ROWS)
    return (
        bars.withColumn("bb_middle", rolling(F.avg, close(), BAND_ROWS))
        .withColumn("spread", spread)
        .withColumn("bb_upper", F.col("bb_middle") + F.col("spread"))
        .withColumn("bb_lower", F.col("bb_middle") - F.col("spread"))
        .withColumn("bb_position", band_position(close(), F.col("bb_lower"), F.col("bb_upper")))
        .drop("spread")
    )


def average_true_range(bars: DataFrame, rows: int = ATR_ROWS) -> DataFrame:
    spread = true_range(F.col("high_price"), F.col("low_price"), earlier(close()))
    return bars.withColumn("true_range", spread).withColumn(
        f"atr_{rows}", rolling(F.avg, "true_range", rows)
    )


def on_balance_volume(bars: DataFrame) -> DataFrame:
    move = signed_volume(close(), earlier(close()), F.col("volume"))
    return (
        bars.withColumn("volume_change", move)
        .withColumn("obv", F.sum("volume_change").over(running()))
        .drop("volume_change")
    )


def relative_volume(volume: Column, mean_volume: Column) -> Column:
    return F.when(mean_volume > 0, ratio(volume, mean_volume)).otherwise(1.0)


def volume_ratio(bars: DataFrame) -> DataFrame:
    return bars.withColumn("volume_sma_20", rolling(F.avg, "volume", VOLUME_ROWS)).withColumn(
        "volume_ratio", relative_volume(F.col("volume"), F.col("volume_sma_20"))
    )


def volatility(bars: DataFrame) -> DataFrame:
    prev = earlier(close())
    return bars.withColumn("daily_return", ratio(close() - prev, prev)).withColumn(
        "volatility_20", rolling(F.stddev_samp, "daily_return", VOLATILITY_ROWS)
    )


def technical_indicators(
    staged: DataFrame,
    keep: Sequence[str] = (),
    volume_move: Column | None = None,
) -> DataFrame:
    """All 26 indicator columns in three window layers over one shuffle by symbol.

    ``keep`` passes extra input columns through, so that later steps need no join back
    to the staged table. ``volume_move`` replaces the signed volume summed into OBV; it
    may use ``signed_volume`` and any input column (incremental runs seed it).
    """
    first, second = stacking(SMA_ROWS)
    priced = staged.withColumns(
        {
            **_direct_averages(SMA_ROWS),
            "prev_close": earlier(close()),
            "fast": rolling(F.avg, close(), MACD_FAST),
            "slow": rolling(F.avg, close(), MACD_SLOW),
            "bb_middle": rolling(F.avg, close(), BAND_ROWS),
            "band_dev": rolling(F.stddev_samp, close(), BAND_ROWS),
            "volume_sma_20": rolling(F.avg, "volume", VOLUME_ROWS),
        }
    )
    prev, change = F.col("prev_close"), close() - F.col("prev_close")
    derived = priced.withColumns(
        {
            "gain": rise(change),
            "loss": fall(change),
            "macd_line": F.col("fast") - F.col("slow"),
            "true_range": true_range(F.col("high_price"), F.col("low_price"), prev),
            "signed_volume": signed_volume(close(), prev, F.col("volume")),
            "daily_return": ratio(change, prev),
            "bb_upper": F.col("bb_middle") + BAND_WIDTH * F.col("band_dev"),
            "bb_lower": F.col("bb_middle") - BAND_WIDTH * F.col("band_dev"),
        }
    )
    move = F.col("signed_volume") if volume_move is None else volume_move
    layered = derived.withColumn("volume_move", move).withColumns(
        {
            "avg_gain": rolling(F.avg, "gain", RSI_ROWS),
            "avg_loss": rolling(F.avg, "loss", RSI_ROWS),
            "macd_signal": rolling(F.avg, "macd_line", MACD_SIGNAL),
            "atr_14": rolling(F.avg, "true_range", ATR_ROWS),
            "obv": F.sum("volume_move").over(running()),
            "volatility_20": rolling(F.stddev_samp, "daily_return", VOLATILITY_ROWS),
            **_stacked_sums(first),
        }
    )
    finished = layered.withColumns(_stacked_sums(second)).withColumns(
        {
            **_stacked_averages(first),
            **_stacked_averages(second),
            "rsi_14": strength_index(F.col("avg_gain"), F.col("avg_loss")),
            "macd_histogram": F.col("macd_line") - F.col("macd_signal"),
            "bb_position": band_position(close(), F.col("bb_lower"), F.col("bb_upper")),
            "volume_ratio": relative_volume(F.col("volume"), F.col("volume_sma_20")),
        }
    )
    return finished.select(*INDICATORS.fieldNames(), *keep)
