"""Signal overview: one row per symbol, and the summaries built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import percent_change
from barloom.operators.analytics import (
    RSI_HIGH,
    RSI_LOW,
    crossed_down,
    crossed_up,
    latest_state,
)

# History floor, signal names and their codes.
MIN_ROWS = 14
OVERALL = ["STRONG BUY", "BUY", "HOLD", "SELL", "STRONG SELL"]
CODES = {
    "STRONG BUY": 2,
    "BUY": 1,
    "BULLISH": 1,
    "NEUTRAL": 0,
    "BEARISH": -1,
    "SELL": -1,
    "STRONG SELL": -2,
}
VOTES = ["rsi_signal", "macd_signal", "bb_signal", "trend_signal"]


def _choose(up: Column, up_name: str, down: Column, down_name: str) -> Column:
    return F.when(up, up_name).when(down, down_name).otherwise("NEUTRAL")


def _overall() -> Column:
    def votes(*names: str) -> Column:
        return sum((F.col(c).isin(*names).cast("int") for c in VOTES), F.lit(0))

    margin = votes("BUY", "BULLISH") - votes("SELL", "BEARISH")
    return (
        F.when(margin > 1, "STRONG BUY")
        .when(margin == 1, "BUY")
        .when(margin == 0, "HOLD")
        .when(margin == -1, "SELL")
        .otherwise("STRONG SELL")
    )


def signal_overview(bars: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Latest values and signals of every symbol with at least 14 bars.

    ``names`` (symbol, name) supplies display names; a symbol without one shows itself.
    """
    s = latest_state(bars).filter(F.col("n_bars") >= MIN_ROWS)
    voted = s.withColumns(
        {
            "rsi_signal": _choose(s.rsi < RSI_LOW, "BUY", s.rsi > RSI_HIGH, "SELL"),
            "macd_signal": _choose(crossed_up(s), "BUY", crossed_down(s), "SELL"),
            "bb_signal": _choose(
                s.close_price < s.bb_lower, "BUY", s.close_price > s.bb_upper, "SELL"
            ),
            "trend_signal": _choose(
                (s.close_price > s.sma_20) & (s.close_price > s.sma_50),
                "BULLISH",
                (s.close_price < s.sma_20) & (s.close_price < s.sma_50),
                "BEARISH",
            ),
            "change_pct": percent_change(s.close_price, s.prev_close),
        }
    ).withColumn("overall_signal", _overall())
    if names is None:
        named = voted.withColumn("name", F.col("symbol"))
    else:
        named = voted.join(names.select("symbol", "name"), "symbol", "left").withColumn(
            "name", F.coalesce("name", "symbol")
        )
    return named.select(
        "symbol",
        "name",
        "sector",
        "close_price",
        "change_pct",
        "rsi",
        "macd",
        "macd_signal_line",
        "sma_20",
        "sma_50",
        "atr",
        F.col("bb_lower").alias("support"),
        F.col("bb_upper").alias("resistance"),
        *VOTES,
        "overall_signal",
        F.col("price_date").alias("last_updated"),
    )


def market_summary(overview: DataFrame) -> DataFrame:
    signal = F.col("overall_signal")
    return overview.agg(
        F.count_if(signal.isin("BUY", "STRONG BUY")).alias("buy_signals"),
        F.count_if(signal.isin("SELL", "STRONG SELL")).alias("sell_signals"),
        F.count_if(signal == "HOLD").alias("hold_signals"),
        F.countDistinct("sector").alias("sectors"),
    )


def sector_pivot(overview: DataFrame) -> DataFrame:
    """Symbols per sector and overall signal, zero where there is none."""
    counts = overview.groupBy("sector").pivot("overall_signal", OVERALL).count().na.fill(0)
    return counts.withColumnsRenamed({n: n.lower().replace(" ", "_") for n in OVERALL})


def signal_distribution(overview: DataFrame) -> DataFrame:
    return overview.groupBy("overall_signal").agg(F.count(F.lit(1)).alias("symbols"))


def signal_codes(overview: DataFrame) -> DataFrame:
    """symbol and the four signals as numbers from -2 to 2."""
    codes = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    return overview.select(
        "symbol", *[codes[F.col(c)].alias(c.replace("_signal", "_code")) for c in VOTES]
    )


def symbol_detail(overview: DataFrame, symbol: str) -> DataFrame:
    return overview.filter(F.col("symbol") == symbol)


def strength_by_price(overview: DataFrame) -> DataFrame:
    """Rows of the RSI against price chart; the average true range is the point size."""
    return overview.select("symbol", "rsi", "close_price", "overall_signal", "atr")
