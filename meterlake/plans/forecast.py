"""Forecast of the average demand of a home from weather and calendar, by gradient-boosted trees."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import calendar
from meterlake.operators.split import last_training_day, training_flag
from meterlake.sources.scratch import ensure_checkpoint_dir, materialize, new_folder

# Fixed values of the model.
FEATURES = ("temp_avg", "month", "weekday", "is_weekend", "is_holiday", "season_idx")
TRAINING_SHARE = 0.75
TREES = 200
DEPTH = 3
LEARNING_RATE = 0.05
SEED = 42
MAX_BINS = 128


def features(totals: DataFrame) -> DataFrame:
    """Days with a target and a temperature; weekday counts from Monday, 0."""
    return totals.na.drop(subset=["avg_kwh_per_home", "temp_avg"]).select(
        "day",
        F.col("avg_kwh_per_home").alias("label"),
        "temp_avg",
        F.month("day").alias("month"),
        F.weekday("day").alias("weekday"),
        "is_weekend",
        "is_holiday",
        calendar.season_index("season").alias("season_idx"),
    )


def time_split(days: DataFrame, share: float = TRAINING_SHARE) -> DataFrame:
    """The feature table with ``is_train``: the earliest share of the days.

    The day-level rows are written once, so that finding the cutoff does not repeat the plan that
    totals the readings.
    """
    saved = materialize(days, "forecast-days")
    return saved.withColumn("is_train", training_flag(last_training_day(saved, share)))


@dataclass(frozen=True)
class Forecast:
    model: GBTRegressionModel
    predictions: DataFrame  # day, actual, prediction over the held-out days
    vectors: DataFrame  # the feature table with is_train and the assembled features


def fit_forecast(days: DataFrame, trees: int = TREES, share: float = TRAINING_SHARE) -> Forecast:
    """Fit on the earliest days and predict the rest."""
    ensure_checkpoint_dir(days.sparkSession)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    # bounded by the calendar: one partition, so that each of the small jobs behind a tree is one task
    vectors = assembler.transform(time_split(days, share).coalesce(1))
    model = GBTRegressor(
        maxIter=trees, maxDepth=DEPTH, stepSize=LEARNING_RATE, seed=SEED, maxBins=MAX_BINS
    ).fit(vectors.filter("is_train"))
    return Forecast(model, materialize(_predicted(model, vectors.filter("NOT is_train")), "forecast"), vectors)


def _predicted(model: GBTRegressionModel, vectors: DataFrame) -> DataFrame:
    return model.transform(vectors).select("day", F.col("label").alias("actual"), "prediction")


def proofs(forecast: Forecast) -> DataFrame:
    """``check, holds``: what is true of a sound fit, whatever the data.

    Over the days it learned from, its squared error is below that of their mean. The weights of the features are not
    negative and add up to 1. The model, saved and loaded again, predicts the same for each held-out day.
    """
    spark = forecast.predictions.sparkSession
    training = forecast.vectors.filter("is_train")
    fit = metrics(_predicted(forecast.model, training)).select((F.col("r2") > 0).alias("holds"))
    weights = importances(forecast).agg(((F.abs(F.sum("importance") - 1) < 1e-9) & (F.min("importance") >= 0)).alias("holds"))
    path = new_folder(spark, "forecast-model")
    forecast.model.save(path)
    again = _predicted(GBTRegressionModel.load(path), forecast.vectors.filter("NOT is_train"))
    same = again.select("day", F.col("prediction").alias("again")).join(forecast.predictions, "day", "full")
    repeated = same.agg((F.count_if(~F.coalesce(F.col("again") == F.col("prediction"), F.lit(False))) == 0).alias("holds"))
    named = {"beats the mean": fit, "weights add up to one": weights, "predicts the same again": repeated}
    return reduce(DataFrame.unionByName, [found.select(F.lit(name).alias("check"), F.coalesce("holds", F.lit(False)).alias("holds")) for name, found in named.items()])


def metrics(predictions: DataFrame) -> DataFrame:
    """``rmse, mae, r2`` of actual against predicted; r2 is null where all actual values are equal."""
    error = F.col("actual") - F.col("prediction")
    return predictions.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop("actual"))).alias("r2"),
    )


def mean_baseline(split: DataFrame) -> DataFrame:
    """``day, actual, prediction`` of the held-out days, predicted by the mean of the training days."""
    mean = split.filter("is_train").agg(F.avg("label").alias("prediction"))
    held_out = split.filter("NOT is_train").select("day", F.col("label").alias("actual"))
    return held_out.crossJoin(F.broadcast(mean))  # one row


def importances(forecast: Forecast) -> DataFrame:
    """``feature, importance``, most important first."""
    rows = [(name, float(score)) for name, score in zip(FEATURES, forecast.model.featureImportances.toArray())]
    scored = forecast.predictions.sparkSession.createDataFrame(rows, "feature string, importance double")
    return scored.orderBy(F.desc("importance"), "feature")
