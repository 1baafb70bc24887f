"""Classifier training, walk-forward validation and scoring on the training mart."""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.series import by_symbol
from barloom.scratch import durable

# Feature vector, target threshold in percent, row floors and defaults.
FEATURES = [
    "daily_range",
    "sma_7", "sma_14", "sma_30", "sma_50", "sma_200",
    "rsi_14",
    "macd_line", "macd_signal", "macd_histogram",
    "bb_position",
    "atr_14",
    "volume_ratio", "obv",
    "volatility_20",
    "lag_1_day_return", "lag_3_day_return", "lag_5_day_return", "lag_7_day_return",
    "momentum_7", "momentum_14", "momentum_30", "momentum_1",
    "ma_crossover_distance", "short_term_trend",
    "price_position_20", "price_position_50",
    "sector_code",
]
THRESHOLD = 1.0
MIN_RAW_ROWS, MIN_VALID_ROWS = 100, 50
MIN_TRAIN_ROWS, MIN_TEST_ROWS = 50, 10
TRAINING_DAYS = 1095
HOLDOUT_TENTHS = 2
# Kept node ids give the same trees: without them every level walks every row through 100 trees.
# They are not checkpointed: ten levels reach the usual interval once, at the last.
FOREST = {
    "numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 5, "seed": 42, "cacheNodeIds": True,
    "checkpointInterval": -1,
}
BOOSTED = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "seed": 42}
TASKS_PER_CORE = 2
MODEL_TYPES = ("random_forest", "gradient_boosting")


def select_features(df: DataFrame, names: Sequence[str] = FEATURES) -> list[str]:
    return [n for n in names if n in df.columns]


def model_columns(mart: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of the mart that training and scoring read, all rows of it.

    ``keep`` names further ones, as ``split`` for the hold-out by date.
    """
    return mart.select(
        "symbol", "price_date", "close_price", "next_day_return", *select_features(mart), *keep
    )


def buy_label(threshold: float = THRESHOLD) -> Column:
    """1 when the next day's return, in percent, is strictly above the threshold."""
    return F.coalesce((F.col("next_day_return") > threshold).cast("int"), F.lit(0))


def training_window(mart: DataFrame, as_of: datetime.date | None, days: int) -> DataFrame:
    """The last ``days`` days before ``as_of``, or all rows without one."""
    if as_of is None:
        return mart
    return mart.filter(F.col("price_date") >= F.lit(as_of - datetime.timedelta(days=days)))


def complete_rows(
    mart: DataFrame, threshold: float = THRESHOLD, keep: Sequence[str] = ()
) -> DataFrame:
    """Key, close, target, features and label of the rows whose features are all known.

    ``keep`` names further columns of the mart to carry along.
    """
    names = select_features(mart)
    return (
        mart.dropna(subset=names)
        .withColumn("label", buy_label(threshold))
        .select("symbol", "price_date", "close_price", "next_day_return", *names, "label", *keep)
    )


def in_symbol(df: DataFrame) -> DataFrame:
    """Adds ``nth``, the 1-based place of a row in its symbol, and drops nothing."""
    return df.withColumn("nth", F.row_number().over(by_symbol()))


def with_start(numbered: DataFrame) -> DataFrame:
    """``position`` instead of the ``nth`` of ``in_symbol``: 0-based, in (symbol, price_date) order.

    ``numbered`` is read twice, so pass something stored. Only one count per symbol is range
    sorted; each sorted slice adds up its own symbols, and what crosses the driver is a
    single number per slice.
    """
    spark = numbered.sparkSession
    counts = durable(
        numbered.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange("symbol")
        .withColumn("slice", F.spark_partition_id())
    )
    offset, offsets = 0, []
    for row in counts.groupBy("slice").agg(F.sum("n").alias("n")).orderBy("slice").collect():
        offsets.append((row["slice"], offset))
        offset += row["n"]
    slices = spark.createDataFrame(offsets, "slice int, slice_start bigint")
    before = (
        Window.partitionBy("slice")
        .orderBy("symbol")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.join(slices, "slice").select(
        "symbol",
        (F.col("slice_start") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"),
    )
    return (
        numbered.join(starts, "symbol")
        .withColumn("position", F.col("start") + F.col("nth") - 1)
        .drop("start", "nth")
    )


def with_position(df: DataFrame) -> DataFrame:
    """Adds ``position``, the 0-based place of a row in (symbol, price_date) order.

    ``df`` is read twice, so pass something stored. See ``with_start``.
    """
    return with_start(in_symbol(df))


def positions(
    mart: DataFrame, columns: Sequence[str] = (), threshold: float = THRESHOLD
) -> DataFrame:
    """Key, ``columns`` and position of the rows of ``training_frame``, without the rest of them.

    Rows are numbered in the partitions in which the mart is made, before anything is stored:
    only these columns are written, and the rows are not shuffled by symbol once more.
    """
    rows = in_symbol(complete_rows(mart, threshold))
    return with_start(durable(rows.select("symbol", "price_date", *columns, "nth")))


def holdout_start(rows: int, tenths: int = HOLDOUT_TENTHS) -> int:
    """Number of training rows when the last tenths, rounded up, are held out."""
    return rows - -(-rows * tenths // 10)


@dataclass(frozen=True)
class Fold:
    fold: int
    train_end: int
    test_end: int

    @property
    def skipped(self) -> bool:
        return self.train_end < MIN_TRAIN_ROWS or self.test_end - self.train_end < MIN_TEST_ROWS


def walk_forward_folds(rows: int, folds: int = 5) -> list[Fold]:
    """Expanding training ranges, each followed by a test block of rows // (folds + 1)."""
    block = rows // (folds + 1)
    found = [Fold(i, i * block, (i + 1) * block) for i in range(1, folds + 1)]
    return [f for f in found if f.test_end <= rows and not f.skipped]


def date_holdout(mart: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Complete rows with ``role``: the mart's train days, or test for its test days.

    The hold-out by position keeps back the last symbols; this one keeps back the newest
    days of all symbols. Validation days take no part.
    """
    rows = complete_rows(mart, threshold, keep=["split"])
    return rows.filter(F.col("split").isin("train", "test")).withColumnRenamed("split", "role")


def training_frame(mart: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Positioned training rows, stored: every fold and every tree reads them again.

    ``mart`` is read twice and should be a stored table.
    """
    return durable(with_position(complete_rows(mart, threshold)))


def classification_metrics(predicted: DataFrame, *groups: str) -> DataFrame:
    """Accuracy and precision, recall, F1 of class 1 (0 where undefined), in one pass."""
    label, guess = F.col("label"), F.col("prediction")
    counts = predicted.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(label == guess).alias("correct"),
        F.count_if((label == 1) & (guess == 1)).alias("hits"),
        F.count_if(guess == 1).alias("guessed"),
        F.count_if(label == 1).alias("actual"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    hits = F.col("hits")
    return counts.select(
        *groups,
        share(F.col("correct"), F.col("n")).alias("accuracy"),
        share(hits, F.col("guessed")).alias("precision"),
        share(hits, F.col("actual")).alias("recall"),
        share(2 * hits, F.col("guessed") + F.col("actual")).alias("f1"),
    )


def estimator(model_type: str, **params):
    if model_type == "random_forest":
        return RandomForestClassifier(**{**FOREST, **params})
    if model_type == "gradient_boosting":
        return GBTClassifier(**{**BOOSTED, **params})
    raise ValueError(f"model_type must be one of {MODEL_TYPES}, not {model_type!r}")


def fit(rows: DataFrame, model_type: str = "random_forest", **params) -> PipelineModel:
    """The fitted pipeline, without the training summary that a forest brings.

    The summary holds the session, and predictions send the model with all it holds to the
    tasks: in a session that has observed a write that fails. A copy has no summary.
    """
    names = select_features(rows)
    # Every task of a level sends statistics of all its nodes, so more tasks only shuffle more.
    tasks = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() > tasks:
        rows = rows.coalesce(tasks)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    return Pipeline(stages=[assembler, estimator(model_type, **params)]).fit(rows).copy()


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``prediction`` and ``buy_probability``; unknown features count as 0."""
    names = model.stages[0].getInputCols()
    scored = model.transform(rows.fillna(0, subset=names))
    return scored.withColumns(
        {
            "prediction": F.col("prediction").cast("int"),
            "buy_probability": vector_to_array("probability")[1],
        }
    ).drop("features", "rawPrediction", "probability")


@dataclass
class Trained:
    model: PipelineModel
    metrics: dict[str, float]
    symbol: str | None
    model_type: str
    threshold: float
    features: list[str]


def training_rows(
    mart: DataFrame,
    symbol: str | None = None,
    threshold: float = THRESHOLD,
    by_date: bool = False,
    as_of: datetime.date | None = None,
    days: int = TRAINING_DAYS,
) -> DataFrame:
    """The stored rows on which ``train_rows`` fits and reports; the mart is not read again."""
    rows = training_window(mart, as_of, days)
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol)
    if rows.limit(MIN_RAW_ROWS).count() < MIN_RAW_ROWS:
        raise ValueError(f"not enough training data, need {MIN_RAW_ROWS} rows")
    return durable(date_holdout(rows, threshold)) if by_date else training_frame(rows, threshold)


def train_model(
    mart: DataFrame,
    symbol: str | None = None,
    model_type: str = "random_forest",
    threshold: float = THRESHOLD,
    by_date: bool = False,
    as_of: datetime.date | None = None,
    days: int = TRAINING_DAYS,
    **params,
) -> Trained:
    """Fit on the first 80 % of the ordered rows, report metrics on the rest.

    ``by_date`` fits on the mart's train days and reports on its test days instead. With
    ``as_of`` only the ``days`` days before it take part.
    """
    frame = training_rows(mart, symbol, threshold, by_date, as_of, days)
    return train_rows(frame, symbol, model_type, threshold, **params)


def train_rows(
    frame: DataFrame,
    symbol: str | None = None,
    model_type: str = "random_forest",
    threshold: float = THRESHOLD,
    **params,
) -> Trained:
    """``train_model`` on its stored rows, when the mart itself is no longer needed."""
    n, by_date = frame.count(), "role" in frame.columns
    if n < MIN_VALID_ROWS:
        raise ValueError(f"not enough complete rows, need {MIN_VALID_ROWS}")
    fitted = F.col("role") == "train" if by_date else F.col("position") < holdout_start(n)
    model = fit(frame.filter(fitted), model_type, **params)
    held_out = predict(model, frame.filter(~fitted))
    return Trained(
        model,
        classification_metrics(held_out).first().asDict(),
        symbol,
        model_type,
        threshold,
        select_features(frame),
    )


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """feature, importance, rank: one row per feature of the vector."""
    names = model.stages[0].getInputCols()
    weights = model.stages[1].featureImportances.toArray()
    ranked = sorted(zip(names, weights, strict=True), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame(
        [(name, float(w), i + 1) for i, (name, w) in enumerate(ranked)],
        "feature string, importance double, rank int",
    )


def top_features(importance: DataFrame, rows: int = 15) -> DataFrame:
    return importance.orderBy("rank").limit(rows)


def prediction_report(model: PipelineModel, mart: DataFrame) -> DataFrame:
    return predict(model, mart).select(
        "symbol", "price_date", "close_price", "next_day_return", "prediction", "buy_probability"
    )


def last_predictions(report: DataFrame, rows: int = 20) -> DataFrame:
    """The last rows in (symbol, price_date) order."""
    return report.orderBy(F.desc("symbol"), F.desc("price_date")).limit(rows)


def prediction_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("prediction").agg(F.count(F.lit(1)).alias("rows"))


def recent_report(report: DataFrame, as_of: datetime.date, days: int = 365) -> DataFrame:
    """Predictions of the last ``days`` days up to ``as_of``."""
    day = F.col("price_date")
    return report.filter(
        (day >= F.lit(as_of - datetime.timedelta(days=days))) & (day <= F.lit(as_of))
    )


def rule_metrics(frame: DataFrame, rule: Column, folds: int = 5) -> DataFrame:
    """Metrics per walk-forward fold of a fixed rule, true where it says buy.

    A baseline for ``cross_validate``: the same test blocks, but nothing to fit. All folds are
    counted in one pass over the positioned rows of ``training_frame``.
    """
    position, fold = F.col("position"), F.lit(None).cast("int")
    for f in walk_forward_folds(frame.count(), folds):
        inside = (position >= f.train_end) & (position < f.test_end)
        fold = F.when(inside, F.lit(f.fold)).otherwise(fold)
    scored = frame.select(fold.alias("fold"), "label", rule.cast("int").alias("prediction"))
    return classification_metrics(scored.filter(F.col("fold").isNotNull()), "fold")


def cross_validate(
    mart: DataFrame,
    model_type: str = "random_forest",
    folds: int = 5,
    inner_holdout_tenths: int = HOLDOUT_TENTHS,
    as_of: datetime.date | None = None,
    days: int = TRAINING_DAYS,
    **params,
) -> DataFrame:
    """Metrics per walk-forward fold.

    Each model is fitted on the first part of its training range only, since the
    trainer keeps its own hold-out; pass 0 to train on the whole range. With ``as_of``
    only the ``days`` days before it take part.
    """
    frame = training_frame(training_window(mart, as_of, days))
    return cross_validate_rows(frame, model_type, folds, inner_holdout_tenths, **params)


def cross_validate_rows(
    frame: DataFrame,
    model_type: str = "random_forest",
    folds: int = 5,
    inner_holdout_tenths: int = HOLDOUT_TENTHS,
    **params,
) -> DataFrame:
    """``cross_validate`` on the rows of ``training_frame``."""
    scored = None
    for f in walk_forward_folds(frame.count(), folds):
        cut = holdout_start(f.train_end, inner_holdout_tenths)
        model = fit(frame.filter(F.col("position") < cut), model_type, **params)
        block = frame.filter(
            (F.col("position") >= f.train_end) & (F.col("position") < f.test_end)
        )
        part = predict(model, block).select(F.lit(f.fold).alias("fold"), "label", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        raise ValueError("not enough rows for a single fold")
    return classification_metrics(scored, "fold")


def average_metrics(fold_metrics: DataFrame) -> DataFrame:
    return fold_metrics.agg(*[F.avg(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


REGISTRY = (
    "symbol string, model_type string, threshold double, metrics string, "
    "features array<string>, path string, trained_at timestamp_ntz"
)


def save_model(
    spark: SparkSession, trained: Trained, folder: str, trained_at: datetime.datetime
) -> str:
    """Write the pipeline and add a row to the registry table; returns the model path."""
    scope = trained.symbol or "all"
    path = f"{folder}/models/{scope}_{trained.model_type}_{trained_at:%Y%m%dT%H%M%S%f}"
    trained.model.write().overwrite().save(path)
    row = (
        scope,
        trained.model_type,
        trained.threshold,
        json.dumps(trained.metrics),
        trained.features,
        path,
        trained_at,
    )
    entry = spark.createDataFrame([row], REGISTRY)
    entry.coalesce(1).write.mode("append").parquet(f"{folder}/registry")
    return path


def latest_model(
    spark: SparkSession, folder: str, symbol: str | None = None, model_type: str | None = None
) -> tuple[PipelineModel, dict] | None:
    """The newest model of a symbol (or of all symbols), with its registry row."""
    rows = spark.read.schema(REGISTRY).parquet(f"{folder}/registry")
    rows = rows.filter(F.col("symbol") == (symbol or "all"))
    if model_type is not None:
        rows = rows.filter(F.col("model_type") == model_type)
    found = rows.orderBy(F.desc("trained_at")).first()
    if found is None:
        return None
    return PipelineModel.load(found["path"]), found.asDict()
