import datetime
import math

import micro
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import forecast, learning, quality
from barloom.plans.queries import mart_table
from barloom.scratch import durable

SF = "/root/testdata/sf0.001"
SMALL = {"numTrees": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def data(spark):
    return durable(mart_table(spark, SF))


def test_positions_equal_one_global_numbering(spark, data):
    frame = learning.training_frame(data)
    rows = frame.select("symbol", "price_date", "position").toPandas()
    rows = rows.sort_values(["symbol", "price_date"])
    assert list(rows["position"]) == list(range(len(rows)))


def test_positions_with_one_dominant_symbol(spark):
    table = micro.bars(
        spark, micro.series("B", range(400)), micro.series("A", [1]), micro.series("C", [1, 2])
    )
    rows = learning.with_position(table).orderBy("symbol", "price_date").collect()
    assert [r["position"] for r in rows] == list(range(403))


def test_feature_vector_and_fold_ranges():
    assert len(learning.FEATURES) == len(set(learning.FEATURES)) == 28
    assert learning.holdout_start(101) == 80
    folds = learning.walk_forward_folds(600, 5)
    assert [(f.fold, f.train_end, f.test_end) for f in folds] == [
        (i, i * 100, (i + 1) * 100) for i in range(1, 6)
    ]
    # too short training ranges and test blocks are skipped
    assert [f.fold for f in learning.walk_forward_folds(150, 5)] == [2, 3, 4, 5]
    assert learning.walk_forward_folds(50, 5) == []


def test_label_is_strict_and_never_null(spark):
    rows = spark.createDataFrame([(1.0,), (1.1,), (None,)], "next_day_return double")
    assert [r[0] for r in rows.select(learning.buy_label(1.0)).collect()] == [0, 1, 0]


def test_metrics_on_known_counts_and_zero_division(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    got = learning.classification_metrics(
        spark.createDataFrame(rows, "label int, prediction int")
    ).first()
    assert got["accuracy"] == 0.7 and got["precision"] == 0.6 and got["recall"] == 0.75
    assert math.isclose(got["f1"], 2 * 0.6 * 0.75 / 1.35)
    none = learning.classification_metrics(
        spark.createDataFrame([(0, 0)], "label int, prediction int")
    ).first()
    assert (none["accuracy"], none["precision"], none["recall"], none["f1"]) == (1, 0, 0, 0)


def test_train_predict_save_and_load(spark, data, tmp_path):
    done = learning.train_model(data, **SMALL)
    again = learning.train_model(data, **SMALL)
    assert done.metrics == again.metrics
    assert all(0 <= v <= 1 for v in done.metrics.values())
    weights = learning.feature_importance(spark, done.model)
    assert math.isclose(weights.agg(F.sum("importance")).first()[0], 1.0)
    assert learning.top_features(weights).count() == 15
    report = learning.prediction_report(done.model, data)
    assert report.count() == data.count()
    assert report.filter("buy_probability < 0 or buy_probability > 1").isEmpty()
    last = learning.last_predictions(report).collect()
    assert len(last) == 20 and last[0]["symbol"] == data.agg(F.max("symbol")).first()[0]
    folder = str(tmp_path)
    day = datetime.datetime(2024, 1, 1)
    learning.save_model(spark, done, folder, day)
    newest = learning.save_model(spark, done, folder, day + datetime.timedelta(days=1))
    model, row = learning.latest_model(spark, folder)
    assert row["path"] == newest and row["features"] == done.features
    assert learning.latest_model(spark, folder, symbol="S1") is None
    a = learning.prediction_report(model, data)
    assert a.exceptAll(report).isEmpty() and report.exceptAll(a).isEmpty()


def test_forest_keeps_node_ids_and_grows_the_same_trees(spark):
    assert learning.estimator("random_forest").getCacheNodeIds()
    rows = spark.range(600).select(
        (F.col("id") % 37).cast("double").alias("rsi_14"),
        (F.col("id") % 11).cast("double").alias("obv"),
        (F.col("id") * 7 % 5 > 2).cast("int").alias("label"),
    )
    kept = learning.fit(rows, **SMALL).stages[1]
    walked = learning.fit(rows, **SMALL, cacheNodeIds=False).stages[1]
    nodes = [[t.toDebugString.partition("\n")[2] for t in m.trees] for m in (kept, walked)]
    assert nodes[0] == nodes[1] and "Predict" in nodes[0][0]


def test_hold_out_by_date_and_training_window(spark, data):
    days = [r[0] for r in data.select("price_date").distinct().orderBy("price_date").collect()]
    early, late = days[len(days) // 2], days[len(days) * 3 // 4]
    day = F.col("price_date")
    split = F.when(day < F.lit(early), "train").when(day < F.lit(late), "validation")
    dealt = data.withColumn("split", split.otherwise("test"))
    roles = learning.date_holdout(dealt)
    assert {r["role"] for r in roles.select("role").distinct().collect()} == {"train", "test"}
    newest_train = roles.filter("role = 'train'").agg(F.max("price_date")).first()[0]
    assert newest_train < early and roles.filter("role = 'test'").agg(
        F.min("price_date")
    ).first()[0] >= late
    done = learning.train_model(dealt, by_date=True, **SMALL)
    assert all(0 <= v <= 1 for v in done.metrics.values())
    with pytest.raises(ValueError, match="not enough training data"):
        learning.train_model(data, as_of=days[-1], days=0, symbol="S1", **SMALL)
    inside = learning.training_window(data, days[-1], 0)
    assert inside.select("price_date").distinct().count() == 1
    assert learning.training_window(data, None, 0) is data


def test_boosting_per_symbol_and_row_floors(spark, data):
    done = learning.train_model(
        data, symbol="S1", model_type="gradient_boosting", maxIter=2, maxDepth=2
    )
    assert done.symbol == "S1" and set(done.metrics) == {"accuracy", "precision", "recall", "f1"}
    with pytest.raises(ValueError, match="not enough training data"):
        learning.train_model(data, symbol="none")
    with pytest.raises(ValueError, match="not enough complete rows"):
        learning.train_model(data.withColumn("rsi_14", F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="model_type"):
        learning.train_model(data, model_type="other")


def test_unknown_features_count_as_zero(spark, data):
    done = learning.train_model(data, **SMALL)
    blank = data.withColumn("rsi_14", F.lit(None).cast("double"))
    zero = data.withColumn("rsi_14", F.lit(0.0))
    a, b = learning.prediction_report(done.model, blank), learning.prediction_report(done.model, zero)
    assert a.exceptAll(b).isEmpty()


def test_cross_validation(spark, data):
    folds = durable(learning.cross_validate(data, folds=3, **SMALL))
    rows = folds.orderBy("fold").collect()
    assert [r["fold"] for r in rows] == [1, 2, 3]
    average = learning.average_metrics(folds).first()
    assert math.isclose(average["accuracy"], np.mean([r["accuracy"] for r in rows]))


def test_forecast_recovers_trend_and_season(spark):
    n = 900
    t = np.arange(n)
    closes = 100 + 0.05 * t + 3 * np.sin(2 * np.pi * t / 7)
    table = micro.bars(
        spark, micro.series("WAVE", list(closes)), micro.series("SHORT", [1.0] * 59)
    )
    got = forecast.forecast(table, 14)
    rows = got.orderBy("ds").toPandas()
    assert set(rows["symbol"]) == {"WAVE"} and len(rows) == 14
    ahead = np.arange(n, n + 14)
    truth = 100 + 0.05 * ahead + 3 * np.sin(2 * np.pi * ahead / 7)
    assert np.abs(rows["yhat"] - truth).max() < 2.0
    assert (rows["yhat_lower"] < rows["yhat"]).all() and (rows["yhat"] < rows["yhat_upper"]).all()
    assert rows["ds"].iloc[0] == micro.day(n) and rows["ds"].iloc[-1] == micro.day(n + 13)
    summary = forecast.forecast_metrics(table, got).first()
    assert summary["current_price"] == closes[-1]
    assert summary["forecast_price"] == rows["yhat"].iloc[-1]
    for bad in (6, 91):
        with pytest.raises(ValueError):
            forecast.forecast(table, bad)


def test_forecast_equals_brute_force_least_squares():
    dates = pd.Series(pd.date_range("2020-01-01", periods=200, freq="B"))
    closes = pd.Series(np.random.default_rng(1).normal(100, 5, 200))
    got = forecast.forecast_series(dates, closes, 10)
    days = dates.to_numpy().astype("datetime64[D]").astype(float)
    x = forecast.design(days, days[0], days[-1] - days[0])
    scale = closes.abs().max()
    root = np.diag(np.sqrt(forecast.penalties() + 1e-9))
    stacked = np.vstack([x, root])
    weights = np.linalg.lstsq(stacked, np.append(closes / scale, np.zeros(x.shape[1])), rcond=None)[0]
    ahead = days[-1] + np.arange(1, 11)
    want = scale * forecast.design(ahead, days[0], days[-1] - days[0]) @ weights
    np.testing.assert_allclose(got["yhat"], want, rtol=1e-6)


def test_quality_counts_failures(spark):
    rows = micro.series("A", [1, 2, 3]) + micro.series("A", [4])
    rows.append(("B", micro.day(0), "wood", None, 1.0, 2.0, 3.0, -1, -1.0))
    table = micro.bars(spark, rows).withColumn("extraction_timestamp", F.lit("x"))
    report = quality.quality_report([(table, quality.staged_checks(["gold"]))])
    found = {(r["column_name"], r["check_name"]): r for r in report.collect()}
    assert len(found) == 16
    bad = {k: r["failing_rows"] for k, r in found.items() if not r["passed"]}
    assert bad == {
        ("open_price", "not_null"): 1,
        ("sector", "accepted_values"): 1,
        ("volume", "not_negative"): 1,
        ("daily_range", "not_negative"): 1,
        ("symbol, price_date", "unique"): 1,
    }
    where = quality.quality_report([(table, quality.staged_checks(["gold"], "symbol = 'B'"))])
    assert where.filter("check_name = 'unique'").first()["failing_rows"] == 0
