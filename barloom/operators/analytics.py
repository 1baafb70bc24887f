"""Per-symbol analytics: full-window indicators, recursive averages, flags and targets.

Unlike the warehouse indicators these are NULL until a frame is full, and their EMA is
recursive. Reports that only need the newest bar go through ``latest_state``: one
grouping per symbol and no window over the whole history.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.recursive import ema_step, scan
from barloom.functions.series import (
    close,
    earlier,
    fall,
    ratio,
    rise,
    rolling,
    signed_volume,
    true_range,
)

# Window lengths, thresholds and retracement levels.
RSI_ROWS, RSI_LOW, RSI_HIGH = 14, 30, 70
FAST, SLOW, SIGNAL = 12, 26, 9
BAND_ROWS, BAND_WIDTH = 20, 2
ATR_ROWS = 14
RANGE_ROWS = 30
REPORT_ROWS = 50
MIN_FLAG_ROWS = 30
SLOPE_ROWS = 20
FIBONACCI = {
    "0.0% (Low)": 0.0,
    "23.6%": 0.236,
    "38.2%": 0.382,
    "50.0%": 0.5,
    "61.8%": 0.618,
    "78.6%": 0.786,
    "100% (High)": 1.0,
}


def strength_index(avg_gain: Column, avg_loss: Column) -> Column:
    """RSI; 100 with gains only, NULL (unknown, never NaN) when nothing moved."""
    return F.when(avg_loss > 0, 100 - 100 / (1 + ratio(avg_gain, avg_loss))).when(
        avg_gain > 0, F.lit(100.0)
    )


def rsi(bars: DataFrame, period: int = RSI_ROWS, min_rows: int | None = None) -> DataFrame:
    """Adds ``rsi``; ``min_rows`` defaults to the full period, 1 gives partial frames."""
    least = period if min_rows is None else min_rows
    change = close() - earlier(close())
    return (
        bars.withColumns({"gain": rise(change), "loss": fall(change)})
        .withColumn(
            "rsi",
            strength_index(
                rolling(F.avg, "gain", period, least), rolling(F.avg, "loss", period, least)
            ),
        )
        .drop("gain", "loss")
    )


def simple_averages(bars: DataFrame) -> DataFrame:
    return bars.withColumns({f"sma_{n}": rolling(F.avg, "close_price", n, n) for n in (20, 50)})


def bollinger(bars: DataFrame, period: int = BAND_ROWS) -> DataFrame:
    middle = rolling(F.avg, "close_price", period, period)
    spread = BAND_WIDTH * rolling(F.stddev_samp, "close_price", period, period)
    return bars.withColumns(
        {"bb_middle": middle, "bb_upper": middle + spread, "bb_lower": middle - spread}
    )


def average_true_range(bars: DataFrame, reference: str = "previous") -> DataFrame:
    """Adds ``atr``; the range is taken against the previous or the same day's close."""
    if reference not in ("previous", "same_day"):
        raise ValueError(f"reference must be 'previous' or 'same_day', not {reference!r}")
    base = earlier(close()) if reference == "previous" else close()
    return (
        bars.withColumn("range", true_range(F.col("high_price"), F.col("low_price"), base))
        .withColumn("atr", rolling(F.avg, "range", ATR_ROWS, ATR_ROWS))
        .drop("range")
    )


def _history(bars: DataFrame, *columns: str) -> DataFrame:
    """symbol, points: the bars of a symbol in date order."""
    point = F.struct("price_date", *columns)
    return bars.groupBy("symbol").agg(F.sort_array(F.collect_list(point)).alias("points"))


def ema(bars: DataFrame, spans: tuple[int, ...] = (FAST, SLOW)) -> DataFrame:
    """symbol, price_date, close_price, ema_<span> …"""

    def state(point: Column, averages: list[Column]) -> Column:
        named = [a.alias(f"ema_{n}") for n, a in zip(spans, averages, strict=True)]
        price = point.getField("close_price")
        return F.struct(
            point.getField("price_date").alias("price_date"), price.alias("close_price"), *named
        )

    def first(point: Column) -> Column:
        return state(point, [point.getField("close_price") for _ in spans])

    def step(previous: Column, point: Column) -> Column:
        price = point.getField("close_price")
        return state(point, [ema_step(previous.getField(f"ema_{n}"), price, n) for n in spans])

    states = scan(F.col("points"), first, step)
    return _history(bars, "close_price").select("symbol", F.inline(states))


def macd_ema(bars: DataFrame) -> DataFrame:
    """symbol, price_date, close_price, macd, macd_signal_line, macd_histogram."""

    def state(point: Column, fast: Column, slow: Column, signal: Column) -> Column:
        return F.struct(
            point.getField("price_date").alias("price_date"),
            point.getField("close_price").alias("close_price"),
            fast.alias("fast"),
            slow.alias("slow"),
            signal.alias("signal"),
        )

    def first(point: Column) -> Column:
        price = point.getField("close_price")
        return state(point, price, price, F.lit(0.0))

    def step(previous: Column, point: Column) -> Column:
        price = point.getField("close_price")
        fast = ema_step(previous.getField("fast"), price, FAST)
        slow = ema_step(previous.getField("slow"), price, SLOW)
        signal = ema_step(previous.getField("signal"), fast - slow, SIGNAL)
        return state(point, fast, slow, signal)

    states = scan(F.col("points"), first, step)
    line, signal = F.col("fast") - F.col("slow"), F.col("signal")
    return (
        _history(bars, "close_price")
        .select("symbol", F.inline(states))
        .select(
            "symbol",
            "price_date",
            "close_price",
            line.alias("macd"),
            signal.alias("macd_signal_line"),
            (line - signal).alias("macd_histogram"),
        )
    )


def _tail(rows: int) -> Column:
    return F.slice("points", F.greatest(F.size("points") - rows + 1, F.lit(1)), F.lit(rows))


def _full(rows: int, value: Column) -> Column:
    return F.when(F.size("points") >= rows, value)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _closing_macd() -> Column:
    """MACD and signal line of the last two bars, folded without keeping the series."""

    def step(acc: Column, point: Column) -> Column:
        price = point.getField("close_price")
        fast = F.coalesce(ema_step(acc.getField("fast"), price, FAST), price)
        slow = F.coalesce(ema_step(acc.getField("slow"), price, SLOW), price)
        signal = F.coalesce(ema_step(acc.getField("signal"), fast - slow, SIGNAL), fast - slow)
        return F.struct(
            fast.alias("fast"),
            slow.alias("slow"),
            signal.alias("signal"),
            (acc.getField("fast") - acc.getField("slow")).alias("prev_line"),
            acc.getField("signal").alias("prev_signal"),
        )

    names = ("fast", "slow", "signal", "prev_line", "prev_signal")
    unknown = F.struct(*[F.lit(None).cast("double").alias(n) for n in names])
    return F.aggregate(F.col("points"), unknown, step)


def _recent_moves() -> Column:
    """Sums over the last 14 bars of gains, losses and both kinds of true range.

    The fold starts one bar earlier to know its close; that bar adds nothing itself,
    unless it is the first of the series and therefore part of the 14.
    """

    def step(acc: Column, point: Column) -> Column:
        price, high, low = (point.getField(f"{c}_price") for c in ("close", "high", "low"))
        prev = acc.getField("prev")
        counted = prev.isNotNull() | (F.size("points") <= RSI_ROWS)

        def grown(name: str, amount: Column) -> Column:
            return (acc.getField(name) + F.when(counted, amount).otherwise(0.0)).alias(name)

        return F.struct(
            price.alias("prev"),
            grown("gain", rise(price - prev)),
            grown("loss", fall(price - prev)),
            grown("range", true_range(high, low, prev)),
            grown("day_range", true_range(high, low, price)),
        )

    start = F.struct(
        F.lit(None).cast("double").alias("prev"),
        *[F.lit(0.0).alias(n) for n in ("gain", "loss", "range", "day_range")],
    )
    return F.aggregate(_tail(RSI_ROWS + 1), start, step)


def _volume_flow() -> Column:
    """Signed volume over the moves among the last 20 bars: the change in OBV."""

    def step(acc: Column, point: Column) -> Column:
        price, volume = point.getField("close_price"), point.getField("volume")
        flow = signed_volume(price, acc.getField("prev"), volume)
        return F.struct(price.alias("prev"), (acc.getField("flow") + flow).alias("flow"))

    start = F.struct(
        F.lit(None).cast("double").alias("prev"), F.lit(0).cast("bigint").alias("flow")
    )
    return F.aggregate(_tail(SLOPE_ROWS), start, step).getField("flow")


def latest_state(bars: DataFrame) -> DataFrame:
    """One row per symbol with every value the reports read from its newest bars.

    ``bars`` needs symbol, sector, price_date, high/low/close_price and volume.
    """
    grouped = _history(bars, "close_price", "high_price", "low_price", "volume", "sector")
    opened = grouped.withColumns(
        {
            "macd_state": _closing_macd(),
            "moves": _recent_moves(),
            "flow": _volume_flow(),
            "closes": F.transform(_tail(BAND_ROWS), lambda p: p.getField("close_price")),
            "last": F.element_at("points", -1),
            "before": F.try_element_at("points", F.lit(-2)),
        }
    ).withColumn("mean_20", _full(BAND_ROWS, _total(F.col("closes")) / BAND_ROWS))
    squares = F.aggregate(
        "closes",
        F.lit(0.0),
        lambda acc, x: acc + (x - F.col("mean_20")) * (x - F.col("mean_20")),
    )
    spread = BAND_WIDTH * F.sqrt(squares / (BAND_ROWS - 1))
    month = _tail(RANGE_ROWS)
    macd, moves = F.col("macd_state"), F.col("moves")
    strength = strength_index(moves.getField("gain"), moves.getField("loss"))
    return opened.select(
        "symbol",
        F.size("points").alias("n_bars"),
        "last.price_date",
        "last.sector",
        "last.close_price",
        F.col("before.close_price").alias("prev_close"),
        _full(RSI_ROWS, strength).alias("rsi"),
        strength.alias("rsi_partial"),
        (macd.getField("fast") - macd.getField("slow")).alias("macd"),
        macd.getField("signal").alias("macd_signal_line"),
        macd.getField("prev_line").alias("prev_macd"),
        macd.getField("prev_signal").alias("prev_macd_signal_line"),
        F.col("mean_20").alias("sma_20"),
        _full(50, _total(F.transform(_tail(50), lambda p: p.getField("close_price"))) / 50).alias(
            "sma_50"
        ),
        (F.col("mean_20") + spread).alias("bb_upper"),
        (F.col("mean_20") - spread).alias("bb_lower"),
        _full(ATR_ROWS, moves.getField("range") / ATR_ROWS).alias("atr"),
        _full(ATR_ROWS, moves.getField("day_range") / ATR_ROWS).alias("atr_same_day"),
        _full(SLOPE_ROWS + 1, F.col("flow") / SLOPE_ROWS).alias("obv_slope"),
        F.array_max(F.transform(month, lambda p: p.getField("high_price"))).alias("high_30"),
        F.array_min(F.transform(month, lambda p: p.getField("low_price"))).alias("low_30"),
    )


def crossed_up(state: DataFrame) -> Column:
    return (state.macd > state.macd_signal_line) & (state.prev_macd <= state.prev_macd_signal_line)


def crossed_down(state: DataFrame) -> Column:
    return (state.macd < state.macd_signal_line) & (state.prev_macd >= state.prev_macd_signal_line)


FLAGS = ["rsi", "macd", "bb", "obv"]


def signal_flags(bars: DataFrame) -> DataFrame:
    """Eight buy/sell flags per symbol; all false below 30 bars or where unknown."""
    s = latest_state(bars)
    conditions = {
        "rsi_buy": s.rsi_partial < RSI_LOW,
        "rsi_sell": s.rsi_partial > RSI_HIGH,
        "macd_buy": crossed_up(s),
        "macd_sell": crossed_down(s),
        "bb_buy": s.close_price < s.bb_lower,
        "bb_sell": s.close_price > s.bb_upper,
        "obv_buy": s.obv_slope > 0,
        "obv_sell": s.obv_slope < 0,
    }
    enough = s.n_bars >= MIN_FLAG_ROWS
    return s.select(
        "symbol",
        "price_date",
        *[F.coalesce(enough & c, F.lit(False)).alias(name) for name, c in conditions.items()],
    )


def recommendation(flags: DataFrame) -> DataFrame:
    """BUY, SELL or HOLD by the majority of the flags."""

    def votes(side: str) -> Column:
        return sum((F.col(f"{f}_{side}").cast("int") for f in FLAGS), F.lit(0))

    buy, sell = votes("buy"), votes("sell")
    return flags.select(
        "symbol",
        buy.alias("buy_signals"),
        sell.alias("sell_signals"),
        F.when(buy > sell, "BUY").when(sell > buy, "SELL").otherwise("HOLD").alias("overall"),
    )


def _level(state: DataFrame, fraction: float) -> Column:
    return state.low_30 + (state.high_30 - state.low_30) * fraction


def fibonacci_levels(bars: DataFrame) -> DataFrame:
    """symbol, level, price: retracement of the last 30 bars' range, seven rows a symbol.

    No more than the newest ``REPORT_ROWS`` bars of a symbol are shuffled and grouped.
    """
    s = latest_state(newest_rows(bars, REPORT_ROWS))
    rows = [
        F.struct(
            F.lit(name).alias("level"),
            (s.high_30 if fraction == 1.0 else _level(s, fraction)).alias("price"),
        )
        for name, fraction in FIBONACCI.items()
    ]
    return s.filter(s.n_bars >= RANGE_ROWS).select("symbol", F.inline(F.array(*rows)))


def target_prices(bars: DataFrame) -> DataFrame:
    """Retracement, range, average and volatility targets of the newest bar.

    The longest average needs ``REPORT_ROWS`` bars; older ones are cut before the shuffle.
    """
    s = latest_state(newest_rows(bars, REPORT_ROWS))
    ranged = s.n_bars >= RANGE_ROWS
    return s.select(
        "symbol",
        s.close_price.alias("current_price"),
        F.when(ranged, _level(s, 0.382)).alias("fib_38"),
        F.when(ranged, _level(s, 0.618)).alias("fib_61"),
        F.when(ranged, _level(s, 0.786)).alias("fib_78"),
        F.when(ranged, s.high_30).alias("fib_high"),
        F.when(ranged, s.low_30).alias("support"),
        F.when(ranged, s.high_30).alias("resistance"),
        "sma_20",
        "sma_50",
        (s.close_price + 2 * s.atr_same_day).alias("upside_target"),
        (s.close_price - 2 * s.atr_same_day).alias("downside_target"),
    )


def newest_rows(bars: DataFrame, rows: int) -> DataFrame:
    """The last bars of each symbol; Spark cuts each map task to ``rows`` a symbol first."""
    newest = Window.partitionBy("symbol").orderBy(F.col("price_date").desc())
    ranked = bars.withColumn("age", F.row_number().over(newest))
    return ranked.filter(F.col("age") <= rows).drop("age")


def latest_change(bars: DataFrame) -> DataFrame:
    """Newest bar of each symbol with its change against the bar before (0 if alone)."""
    bar = F.struct("price_date", "close_price")
    ends = (
        newest_rows(bars.select("symbol", "price_date", "close_price"), 2)
        .groupBy("symbol")
        .agg(F.max(bar).alias("last"), F.min(bar).alias("before"))
    )
    change = F.col("last.close_price") - F.col("before.close_price")
    return ends.select(
        "symbol",
        "last.price_date",
        "last.close_price",
        change.alias("price_change"),
        (ratio(change, F.col("before.close_price")) * 100).alias("price_change_pct"),
    )


def recent_bars(bars: DataFrame, rows: int = 10) -> DataFrame:
    """The last bars of each symbol, prices rounded half to even at two places."""
    prices = ["open_price", "high_price", "low_price", "close_price"]
    return newest_rows(bars, rows).select(
        "symbol",
        "price_date",
        *[(F.rint(F.col(c) * 100) / 100).alias(c) for c in prices],
        "volume",
    )


def since(bars: DataFrame, as_of: datetime.date, days: int) -> DataFrame:
    """Bars of the last ``days`` calendar days before a given date."""
    return bars.filter(F.col("price_date") >= F.lit(as_of - datetime.timedelta(days=days)))
