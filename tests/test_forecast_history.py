"""Fitted values of the past days in the forecast."""

import micro
import numpy as np

from barloom.operators import forecast
from barloom.plans.queries import all_queries


def test_history_comes_before_the_days_ahead(spark):
    n = 200
    t = np.arange(n)
    closes = list(100 + 0.05 * t + 3 * np.sin(2 * np.pi * t / 7))
    table = micro.bars(spark, micro.series("WAVE", closes), micro.series("SHORT", [1.0] * 59))
    whole = forecast.forecast(table, 14, history=True).orderBy("ds").toPandas()
    ahead = forecast.forecast(table, 14).orderBy("ds").toPandas()
    assert whole["ds"].tolist() == [micro.day(k) for k in range(n + 14)]
    assert whole.tail(14).reset_index(drop=True).equals(ahead)
    assert np.abs(whole["yhat"][:n] - closes).max() < 2.0
    assert (whole["yhat_lower"] < whole["yhat"]).all() and (whole["yhat"] < whole["yhat_upper"]).all()
    plain, past = (forecast.forecast_metrics(table, x) for x in (
        forecast.forecast(table, 14), forecast.forecast(table, 14, history=True)
    ))
    assert plain.first() == past.first()


def test_registered_forecast_has_the_bars_days(spark):
    from barloom.sources.star_bars import star_bars

    sf_dir = "/root/testdata/sf0.001"
    bars = star_bars(spark, sf_dir)
    rows = all_queries()["forecast"](spark, sf_dir)
    symbols = rows.select("symbol").distinct().count()
    assert rows.count() == bars.dropna(subset=["close_price"]).count() + 30 * symbols
