"""What keeps the long windows, the rounding and the numbering of rows cheap."""

import re

import micro
import pytest
from pyspark.sql import functions as F

from barloom.functions.series import close, rolling
from barloom.operators import features, indicators, learning
from barloom.plans import queries
from barloom.scratch import durable

SF = "/root/testdata/sf0.001"


def frames(df):
    """Rows before the current one of every moving frame in the plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [int(n) for n in re.findall(r"RowFrame, -(\d+), currentrow", plan)]


def odd_bars(spark):
    """Series longer and shorter than every frame, with gaps, flat parts and odd numbers."""
    wave = [100 + (7 * i % 31) / 3 for i in range(420)]
    flat = [0.1] * 230 + [0.3] * 40
    table = micro.bars(
        spark, micro.series("A", wave), micro.series("B", flat), micro.series("C", [1, 2, 3])
    )
    day = F.dayofyear("price_date")
    gaps = {
        "close_price": F.when(day % 13 != 0, F.col("close_price")),
        "low_price": F.when(day % 11 == 0, None)
        .when(day % 17 == 0, F.lit(float("nan")))
        .otherwise(F.col("low_price")),
        "high_price": F.when(day % 19 != 0, F.col("high_price")),
    }
    return durable(table.withColumns(gaps))


def test_no_frame_adds_up_more_than_26_rows(spark):
    ti = indicators.technical_indicators(odd_bars(spark), keep=["sector"])
    assert 0 < max(frames(features.ml_features(ti))) < 26
    assert 0 < max(frames(indicators.moving_averages(odd_bars(spark)))) < 26


@pytest.mark.parametrize("rows", [indicators.SMA_ROWS, (5, 60, 90, 180)])
def test_stacked_averages_equal_whole_frames(spark, rows):
    table = odd_bars(spark)
    got = indicators.moving_averages(table, rows)
    assert got.columns == [*table.columns, *[f"sma_{n}" for n in rows]]
    whole = {f"whole_{n}": rolling(F.avg, close(), n) for n in rows}
    seen = got.withColumns(whole).collect()
    for row in seen:
        for n in rows:
            assert row[f"sma_{n}"] == pytest.approx(row[f"whole_{n}"], rel=1e-12)
    if rows == indicators.SMA_ROWS:
        first = [r for r in seen if r["symbol"] == "A"]
        first = sorted(first, key=lambda r: r["price_date"])[:50]
        assert all(r["sma_50"] == r["sma_200"] for r in first)


def test_stacked_extremes_equal_whole_frames(spark):
    table = odd_bars(spark)
    got = features.support_resistance(table)
    whole = {f"low_{n}": rolling(F.min, "low_price", n) for n in features.RANGE_ROWS}
    whole |= {f"high_{n}": rolling(F.max, "high_price", n) for n in features.RANGE_ROWS}
    for row in got.withColumns(whole).collect():
        for n in features.RANGE_ROWS:
            assert repr(row[f"support_{n}"]) == repr(row[f"low_{n}"])
            assert repr(row[f"resistance_{n}"]) == repr(row[f"high_{n}"])


@pytest.mark.parametrize("columns", [1, 20])
def test_rounding_equals_decimal_text(spark, columns):
    odd = [
        0.0, -0.0, 1e-9, -1e-9, 5e-7, -5e-7, 1.5e-6, 2.5e-6, 0.1234565, 1.0000005, 1.0000015,
        1099511.6277755, 1099511.7, 123456789.1234565, 1e17, -1e300, float("inf"), float("-inf"),
        float("nan"), None, 2.675, 1 / 3, -2 / 3,
    ]
    more = [(i - 500) * 1e-6 / 2 + i / 7 * (i % 3) for i in range(1000)]
    table = spark.createDataFrame([(x,) for x in odd + more], "x double")
    table = table.withColumns({f"c{i}": F.col("x") for i in range(columns)})
    wanted = table.select(F.round("x", 6).alias("want"), *[f"c{i}" for i in range(columns)])
    for row in queries.rounded(wanted.withColumn("want", F.col("want").cast("string"))).collect():
        want = None if row["want"] is None else float(row["want"])
        for i in range(columns):
            got = row[f"c{i}"]
            assert repr(got) == repr(want)


@pytest.mark.parametrize("name", ["training_mart", "ml_features", "technical_indicators"])
def test_every_stage_stays_small_enough_to_be_compiled(spark, capsys, name):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        queries.all_queries()[name](spark, SF).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_positions_are_those_of_the_training_frame_without_another_shuffle(spark):
    mart = durable(queries.mart_table(spark, SF))
    want = learning.training_frame(mart).select("symbol", "price_date", "position", "label")
    got = learning.positions(mart, ["label"])
    assert got.columns == ["symbol", "price_date", "label", "position"]
    assert want.exceptAll(got.select(want.columns)).isEmpty() and got.count() == want.count()
    # The numbering adds no exchange to those of the mart.
    unstored = queries.mart_table(spark, SF)
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert count(learning.in_symbol(learning.complete_rows(unstored))) == count(unstored)
