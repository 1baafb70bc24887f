"""Small hand-made series."""

import datetime

START = datetime.date(2020, 1, 1)
BARS = (
    "symbol string, price_date date, sector string, open_price double, high_price double, "
    "low_price double, close_price double, volume bigint, daily_range double"
)


def day(n):
    return START + datetime.timedelta(days=n)


def series(symbol, closes, spread=0.0, sector="gold", volume=100):
    return [
        (symbol, day(i), sector, c, c + spread, c - spread, c, volume, 2.0 * spread)
        for i, c in enumerate(float(x) for x in closes)
    ]


def bars(spark, *groups):
    return spark.createDataFrame([r for g in groups for r in g], BARS)


def by_key(df):
    return {(r["symbol"], r["price_date"]): r for r in df.collect()}
