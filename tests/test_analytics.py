import math

import micro
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.recursive import CHUNK
from barloom.operators import analytics, signals


def walk(seed, n):
    rng = np.random.default_rng(seed)
    return [float(x) for x in 50 + np.cumsum(rng.normal(size=n))]


@pytest.mark.parametrize("n", [1, 2, CHUNK, CHUNK + 1, CHUNK + 2, 3 * CHUNK + 7])
def test_ema_equals_pandas(spark, n):
    closes = walk(n, n)
    rows = analytics.macd_ema(micro.bars(spark, micro.series("A", closes))).orderBy("price_date")
    s = pd.Series(closes)
    line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
    signal = line.ewm(span=9, adjust=False).mean()
    got = rows.toPandas()
    assert len(got) == n
    np.testing.assert_allclose(got["macd"], line, atol=1e-11)
    np.testing.assert_allclose(got["macd_signal_line"], signal, atol=1e-11)
    smooth = analytics.ema(micro.bars(spark, micro.series("A", closes)), (5,)).toPandas()
    np.testing.assert_allclose(
        smooth.sort_values("price_date")["ema_5"], s.ewm(span=5, adjust=False).mean(), atol=1e-11
    )


def sizes(spark):
    lengths = (1, 2, 13, 14, 15, 19, 20, 21, 29, 30, 50, 60, 130)
    return micro.bars(spark, *[micro.series(f"N{n}", walk(n, n), spread=1.5) for n in lengths])


def test_latest_state_equals_the_windows(spark):
    """The grouped form and the window form of every indicator agree on the last bar."""
    table = sizes(spark)
    windowed = analytics.simple_averages(
        analytics.bollinger(analytics.average_true_range(analytics.rsi(table)))
    )
    macd = analytics.macd_ema(table)
    last = micro.by_key(windowed)
    lines = micro.by_key(macd)
    partial = micro.by_key(analytics.rsi(table, min_rows=1))
    same_day = micro.by_key(analytics.average_true_range(table, "same_day"))
    for row in analytics.latest_state(table).collect():
        key = (row["symbol"], row["price_date"])
        pairs = [
            (row["rsi"], last[key]["rsi"]),
            (row["rsi_partial"], partial[key]["rsi"]),
            (row["atr"], last[key]["atr"]),
            (row["atr_same_day"], same_day[key]["atr"]),
            (row["sma_20"], last[key]["sma_20"]),
            (row["sma_50"], last[key]["sma_50"]),
            (row["bb_upper"], last[key]["bb_upper"]),
            (row["bb_lower"], last[key]["bb_lower"]),
            (row["macd"], lines[key]["macd"]),
            (row["macd_signal_line"], lines[key]["macd_signal_line"]),
        ]
        for got, want in pairs:
            assert (got is None) == (want is None), key
            assert got is None or math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-9), key


def test_flags_and_overview_respect_history_floors(spark):
    table = sizes(spark)
    flags = {r["symbol"]: r for r in analytics.signal_flags(table).collect()}
    names = [c for c in flags["N1"].asDict() if c.endswith(("_buy", "_sell"))]
    assert len(names) == 8
    for symbol, row in flags.items():
        if int(symbol[1:]) < 30:
            assert not any(row[n] for n in names)
    shown = {r["symbol"] for r in signals.signal_overview(table).collect()}
    assert shown == {r for r in flags if int(r[1:]) >= 14}
    levels = analytics.fibonacci_levels(table)
    assert levels.filter("symbol = 'N29'").count() == 0
    assert levels.filter("symbol = 'N30'").count() == 7
    targets = {r["symbol"]: r for r in analytics.target_prices(table).collect()}
    assert targets["N29"]["fib_38"] is None and targets["N30"]["fib_38"] is not None


def test_flat_series_is_neutral(spark):
    table = micro.bars(spark, micro.series("FLAT", [5.0] * 60))
    row = signals.signal_overview(table).first()
    assert row["rsi"] is None and row["overall_signal"] == "HOLD"
    assert row["trend_signal"] == row["rsi_signal"] == row["macd_signal"] == "NEUTRAL"


def test_strong_signals(spark):
    fall = [100.0] * 40 + [99, 98, 97, 90, 80]
    rise = [100.0] * 40 + [101, 102, 103, 110, 120]
    table = micro.bars(spark, micro.series("DOWN", fall), micro.series("UP", rise))
    rows = {r["symbol"]: r for r in signals.signal_overview(table).collect()}
    assert (rows["DOWN"]["rsi_signal"], rows["DOWN"]["bb_signal"]) == ("BUY", "BUY")
    assert (rows["UP"]["rsi_signal"], rows["UP"]["bb_signal"]) == ("SELL", "SELL")
    summary = signals.market_summary(signals.signal_overview(table)).first()
    assert summary["buy_signals"] + summary["sell_signals"] + summary["hold_signals"] == 2
    assert summary["sectors"] == 1
    codes = {r["symbol"]: r for r in signals.signal_codes(signals.signal_overview(table)).collect()}
    assert codes["UP"]["rsi_code"] == -1 and codes["DOWN"]["rsi_code"] == 1


def test_single_bar_change_and_names(spark):
    table = micro.bars(spark, micro.series("ONE", [5.0]), micro.series("TWO", [4.0, 5.0]))
    rows = {r["symbol"]: r for r in analytics.latest_change(table).collect()}
    assert rows["ONE"]["price_change"] == 0 and rows["ONE"]["price_change_pct"] == 0
    assert rows["TWO"]["price_change_pct"] == 25
    names = spark.createDataFrame([("N14", "Fourteen")], "symbol string, name string")
    shown = {r["symbol"]: r["name"] for r in signals.signal_overview(sizes(spark), names).collect()}
    assert shown["N14"] == "Fourteen" and shown["N15"] == "N15"


def test_recent_bars_round_like_pandas(spark):
    closes = [0.125, 0.375, 2.675, 1.005, 7.0]
    table = micro.bars(spark, micro.series("A", closes))
    got = analytics.recent_bars(table, 4).orderBy("price_date").toPandas()["close_price"]
    assert list(got) == list(pd.Series(closes[1:]).round(2))
    assert analytics.recent_bars(table).agg(F.count("*")).first()[0] == 5
