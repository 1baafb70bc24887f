import math

import micro
from pyspark.sql import functions as F

from barloom.operators import features, indicators, mart
from barloom.schemas import FEATURES, INDICATORS, MART
from barloom.scratch import durable
from barloom.sources.star_bars import star_bars


def test_first_rows_use_partial_frames(spark):
    table = micro.bars(spark, micro.series("A", [10, 12, 11], spread=1))
    rows = micro.by_key(indicators.technical_indicators(table))
    first, third = rows["A", micro.day(0)], rows["A", micro.day(2)]
    assert first["sma_200"] == 10 and third["sma_200"] == 11
    assert first["rsi_14"] == 100
    assert first["atr_14"] == 2 and first["obv"] == 0
    assert first["bb_upper"] is None and first["bb_position"] is None
    assert first["volatility_20"] is None and rows["A", micro.day(1)]["volatility_20"] is None
    assert third["obv"] == 0
    assert math.isclose(third["rsi_14"], 100 - 100 / (1 + (2 / 3) / (1 / 3)))


def test_flat_rising_falling_and_zero_prices(spark):
    table = micro.bars(
        spark,
        micro.series("FLAT", [5.0] * 30),
        micro.series("UP", range(1, 31)),
        micro.series("DOWN", range(30, 0, -1)),
        micro.series("ZERO", [0.0, 0.0, 1.0, 0.0]),
    )
    featured = features.ml_features(indicators.technical_indicators(table), table)
    rows = micro.by_key(featured)
    flat = rows["FLAT", micro.day(29)]
    assert flat["rsi_14"] == 100 and flat["bb_position"] == 0
    assert flat["price_position_20"] == 0.5 and flat["volatility_20"] == 0
    assert rows["UP", micro.day(29)]["rsi_14"] == 100
    assert rows["DOWN", micro.day(29)]["rsi_14"] == 0
    zero = rows["ZERO", micro.day(2)]
    assert zero["lag_1_day_return"] is None and zero["momentum_1"] == 1
    labelled = micro.by_key(mart.label(featured))
    assert labelled["ZERO", micro.day(1)]["next_day_return"] is None


def test_no_volume_gives_ratio_one(spark):
    table = micro.bars(spark, micro.series("A", [1, 2], volume=0))
    assert {r["volume_ratio"] for r in indicators.technical_indicators(table).collect()} == {1.0}


def test_crosses_are_exclusive_and_flag_one_day(spark):
    down_up = [100 - i * 0.1 for i in range(220)] + [78 + i for i in range(60)]
    table = micro.bars(spark, micro.series("A", down_up))
    crossed = features.average_crosses(indicators.moving_averages(table))
    counts = crossed.agg(
        F.sum("golden_cross_signal").alias("g"),
        F.sum("death_cross_signal").alias("d"),
        F.sum(F.col("golden_cross_signal") * F.col("death_cross_signal")).alias("both"),
    ).first()
    assert (counts["g"], counts["d"], counts["both"]) == (1, 1, 0)


def test_sector_is_the_first_one(spark):
    rows = micro.series("A", [1, 2, 3])
    changed = [r if i < 2 else (*r[:2], "oil", *r[3:]) for i, r in enumerate(rows)]
    table = micro.bars(spark, changed)
    from_stage = features.ml_features(indicators.technical_indicators(table), table)
    carried = features.ml_features(indicators.technical_indicators(table, keep=["sector"]))
    assert {r["sector"] for r in from_stage.collect()} == {"gold"}
    assert {r["sector"] for r in carried.collect()} == {"gold"}


def test_sector_means_do_not_depend_on_the_join(spark):
    table = star_bars(spark, "/root/testdata/sf0.001")
    small = features.sector_momentum(table)
    large = features.sector_momentum(table)
    digits = [F.round(c, 6).alias(c) for c in small.columns if c.endswith("return")]
    key = ["symbol", "price_date", "sector"]
    a = durable(small.select(*key, *digits))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = durable(large.select(*key, *digits))
        plan = large._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert "broadcast" not in plan


def test_one_pass_equals_the_joined_operators(spark):
    table = star_bars(spark, "/root/testdata/sf0.001").withColumn(
        "daily_range", F.col("high_price") - F.col("low_price")
    )
    key = ["symbol", "price_date"]
    joined = table.select(*key)
    parts = [
        (indicators.moving_averages, "sma_7 sma_14 sma_30 sma_50 sma_200"),
        (indicators.rsi, "rsi_14"),
        (indicators.macd_sma, "macd_line macd_signal macd_histogram"),
        (indicators.bollinger, "bb_middle bb_upper bb_lower bb_position"),
        (indicators.average_true_range, "atr_14"),
        (indicators.on_balance_volume, "obv"),
        (indicators.volume_ratio, "volume_sma_20 volume_ratio"),
        (indicators.volatility, "volatility_20"),
    ]
    names = []
    for operator, columns in parts:
        names += columns.split()
        joined = joined.join(operator(table).select(*key, *columns.split()), key, "left")
    digits = [F.round(n, 6).alias(n) for n in names]
    one = indicators.technical_indicators(table).select(*key, *digits)
    many = joined.select(*key, *digits)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_properties(spark):
    table = star_bars(spark, "/root/testdata/sf0.001").withColumn(
        "daily_range", F.col("high_price") - F.col("low_price")
    )
    featured = features.ml_features(indicators.technical_indicators(table, keep=["sector"]))
    wrong = featured.filter(
        "rsi_14 < 0 or rsi_14 > 100 or bb_lower > bb_middle or bb_middle > bb_upper"
        " or close_price < support_20 or close_price > resistance_20"
        " or support_50 > support_20 or resistance_50 < resistance_20"
        " or price_position_20 not between 0 and 1"
        " or abs(macd_histogram - (macd_line - macd_signal)) > 1e-9"
        " or golden_cross_signal + death_cross_signal > 1"
    )
    assert wrong.isEmpty()


def test_declared_schemas(spark):
    table = micro.bars(spark, micro.series("A", [1, 2]))
    ti = indicators.technical_indicators(table, keep=["sector"])
    assert (len(INDICATORS), len(FEATURES), len(MART)) == (26, 45, 50)
    for df, want in (
        (ti.drop("sector"), INDICATORS),
        (features.ml_features(ti), FEATURES),
        (mart.training_mart(features.ml_features(ti)), MART),
    ):
        assert df.schema.simpleString() == want.simpleString()


def test_whole_chain_shuffles_once_by_symbol(spark, tmp_path):
    micro.bars(spark, micro.series("A", [1, 2])).write.parquet(str(tmp_path / "staged"))
    table = spark.read.parquet(str(tmp_path / "staged"))
    built = mart.training_mart(
        features.ml_features(indicators.technical_indicators(table, keep=["sector"]))
    )
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Join") == 0
    assert plan.count("Sort [") == 1


def test_default_cut_offs(spark):
    days = spark.sql(
        "select explode(array(date'2019-05-01', date'2021-01-01', date'2023-12-31',"
        " date'2024-01-01', date'2025-01-01', date'2027-01-01')) as price_date"
    )
    settings = mart.MartSettings()
    rows = days.select(mart.split_label(settings), mart.fold_number(settings)).collect()
    assert [tuple(r) for r in rows] == [
        ("train", 0), ("train", 1), ("train", 3),
        ("validation", 4), ("test", 5), ("test", 5),
    ]


def test_folds_follow_the_listed_years_in_order(spark):
    settings = mart.MartSettings(fold_years=(2021, 2024))
    days = spark.sql(
        "select explode(array(date'2020-06-01', date'2022-06-01', date'2024-06-01',"
        " date'2026-06-01')) as price_date"
    )
    assert [r[0] for r in days.select(mart.fold_number(settings)).collect()] == [0, 1, 2, 2]
