"""Price forecast per symbol: trend with change points plus weekly and yearly seasons.

Each symbol is fitted on its own by regularised least squares, inside the task that
holds its bars (one per day, so a few thousand rows). Horizons are calendar days.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import percent_change

# History floor, horizons, model terms and the 80 % interval.
MIN_ROWS = 60
HORIZON_DAYS = 30
MIN_HORIZON, MAX_HORIZON = 7, 90
CHANGE_POINTS = 25
CHANGE_RANGE = 0.8
SEASONS = ((7.0, 3), (365.25, 10))
CHANGE_PENALTY, SEASON_PENALTY = 1.0 / 0.05, 1.0 / 10.0
INTERVAL_Z = 1.2816

SCHEMA = "symbol string, ds date, yhat double, yhat_lower double, yhat_upper double"


def design(days: np.ndarray, start: float, span: float) -> np.ndarray:
    """Columns: 1, t, one hinge per change point, sine and cosine per season order."""
    t = (days - start) / span
    knots = np.linspace(0.0, CHANGE_RANGE, CHANGE_POINTS + 1)[1:]
    columns = [np.ones_like(t), t, *(np.maximum(t - k, 0.0) for k in knots)]
    for period, order in SEASONS:
        for k in range(1, order + 1):
            angle = 2.0 * np.pi * k * days / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def penalties() -> np.ndarray:
    seasons = 2 * sum(order for _, order in SEASONS)
    return np.concatenate(
        [np.zeros(2), np.full(CHANGE_POINTS, CHANGE_PENALTY), np.full(seasons, SEASON_PENALTY)]
    )


def forecast_series(
    dates: pd.Series, closes: pd.Series, horizon: int, history: bool = False
) -> pd.DataFrame:
    """Fit one series and predict the days after its last date, with ``history`` its own too."""
    days = pd.to_datetime(dates).to_numpy().astype("datetime64[D]").astype(float)
    order = np.argsort(days)
    days, y = days[order], closes.to_numpy(dtype=float)[order]
    start, span = days[0], max(days[-1] - days[0], 1.0)
    scale = np.abs(y).max() or 1.0
    x = design(days, start, span)
    weights = np.linalg.solve(
        x.T @ x + np.diag(penalties() + 1e-9), x.T @ (y / scale)
    )
    deviation = np.std(y - scale * (x @ weights), ddof=1)
    ahead = days[-1] + np.arange(1, horizon + 1)
    shown = ahead
    if history:
        shown = np.concatenate((np.unique(days), ahead))
    yhat = scale * (design(shown, start, span) @ weights)
    return pd.DataFrame(
        {
            "ds": shown.astype("datetime64[D]").astype("datetime64[s]"),
            "yhat": yhat,
            "yhat_lower": yhat - INTERVAL_Z * deviation,
            "yhat_upper": yhat + INTERVAL_Z * deviation,
        }
    )


def forecast(
    bars: DataFrame, horizon_days: int = HORIZON_DAYS, history: bool = False
) -> DataFrame:
    """symbol, ds, yhat, yhat_lower, yhat_upper for symbols with at least 60 bars.

    With ``history`` the fitted values of the symbol's own days come before the days ahead.
    """
    if not MIN_HORIZON <= horizon_days <= MAX_HORIZON:
        raise ValueError(f"horizon_days must be between {MIN_HORIZON} and {MAX_HORIZON}")

    def fit_symbol(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < MIN_ROWS:
            return pd.DataFrame(columns=["symbol", "ds", "yhat", "yhat_lower", "yhat_upper"])
        out = forecast_series(pdf["price_date"], pdf["close_price"], horizon_days, history)
        out["ds"] = out["ds"].dt.date
        out.insert(0, "symbol", key[0])
        return out

    known = bars.select("symbol", "price_date", "close_price").dropna()
    return known.groupBy("symbol").applyInPandas(fit_symbol, SCHEMA)


def forecast_metrics(bars: DataFrame, predictions: DataFrame) -> DataFrame:
    """Last price against the last predicted day, with the interval there."""
    end = predictions.groupBy("symbol").agg(
        F.max_by(F.struct("yhat", "yhat_lower", "yhat_upper"), "ds").alias("end")
    )
    last = bars.groupBy("symbol").agg(F.max_by("close_price", "price_date").alias("current_price"))
    return last.join(end, "symbol").select(
        "symbol",
        "current_price",
        F.col("end.yhat").alias("forecast_price"),
        percent_change(F.col("end.yhat"), F.col("current_price")).alias("forecast_change_pct"),
        F.col("end.yhat_lower").alias("min_forecast"),
        F.col("end.yhat_upper").alias("max_forecast"),
    )
