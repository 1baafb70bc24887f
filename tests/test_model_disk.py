"""What model queries keep on disk: model columns only, no mart while fitting, no checkpoints."""

import os

import micro
import pytest
from pyspark.sql import functions as F

from barloom import scratch
from barloom.operators import learning

SMALL = {"numTrees": 3, "maxDepth": 2}


@pytest.fixture(scope="module")
def rows(spark):
    closes = [100 + (i * 37 % 11) for i in range(200)]
    bars = micro.bars(spark, micro.series("A", closes), micro.series("B", closes[::-1]))
    return bars.withColumns(
        {
            "next_day_return": F.col("close_price") - 104,
            "rsi_14": F.col("close_price") % 7,
            "obv": F.col("close_price") % 3,
            "note": F.lit("x"),
        }
    )


def test_model_columns_keep_all_rows_and_only_what_models_read(rows):
    kept = learning.model_columns(rows, keep=["note"])
    assert kept.columns == [
        "symbol", "price_date", "close_price", "next_day_return", "daily_range", "rsi_14", "obv",
        "note",
    ]
    assert kept.count() == 400


def test_models_are_fitted_after_the_mart_is_gone(spark, rows):
    want = learning.train_model(scratch.durable(rows), **SMALL)
    with scratch.passing(learning.model_columns(rows)) as mart:
        frame = learning.training_rows(mart)
    got = learning.train_rows(frame, **SMALL)
    assert got.metrics == want.metrics and got.features == want.features
    assert got.model.stages[1].toDebugString.partition("\n")[2] == (
        want.model.stages[1].toDebugString.partition("\n")[2]
    )


def test_forest_writes_no_checkpoint(spark, rows, tmp_path):
    context = spark.sparkContext
    context.setCheckpointDir(str(tmp_path))
    deep = scratch.durable(learning.complete_rows(rows))
    learning.fit(deep, numTrees=2, minInstancesPerNode=1)
    assert learning.estimator("random_forest").getCheckpointInterval() == -1
    assert not [f for _, _, files in os.walk(tmp_path) for f in files]


def test_fit_takes_no_more_tasks_than_twice_the_cores(spark, rows, monkeypatch):
    seen = []
    plain = learning.Pipeline.fit
    monkeypatch.setattr(
        learning.Pipeline, "fit", lambda p, df: seen.append(df.rdd.getNumPartitions()) or plain(p, df)
    )
    cores = spark.sparkContext.defaultParallelism
    for parts in (5 * cores, cores):
        learning.fit(scratch.durable(learning.complete_rows(rows)).repartition(parts), **SMALL)
    assert seen == [2 * cores, cores]
