"""Models are fitted and used in a session that has observed a write before."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from barloom.operators import learning


@pytest.mark.parametrize("kind", learning.MODEL_TYPES)
def test_training_after_an_observation(spark, kind):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    data = spark.range(200).selectExpr(
        "concat('S', id % 2) AS symbol",
        "date_add(date'2020-01-01', cast(id / 2 AS int)) AS price_date",
        "1.0D AS close_price",
        "IF(id % 3 = 0, 2.0D, 0.0D) AS next_day_return",
        "CAST(id % 3 AS double) AS rsi_14",
    )
    size = {"numTrees": 2} if kind == "random_forest" else {"maxIter": 2}
    done = learning.train_model(data, model_type=kind, maxDepth=2, **size)
    assert done.metrics["accuracy"] == 1.0
    report = learning.prediction_report(done.model, data).collect()
    assert [r["prediction"] for r in report] == [int(r["next_day_return"] > 1) for r in report]
