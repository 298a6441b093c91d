"""Quality measures and report tables. All are small aggregates over predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.classes import name_of
from daybook.functions.losses import log_loss


def accuracy(predictions: DataFrame, pred: str = "pred", label: str = "cls", by: Sequence[str] = ("part",)) -> DataFrame:
    hit = (F.col(pred) == F.col(label)).cast("double")
    return predictions.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("days"))


def rmse_units(
    predictions: DataFrame, low: float, high: float, pred: str = "pred", target: str = "y", by: Sequence[str] = ("part",)
) -> DataFrame:
    """Mean squared error of scaled predictions, and its root brought back to units."""
    mse = F.avg(F.pow(F.col(pred) - F.col(target), F.lit(2)))
    span = F.lit(float(high) - float(low))
    return predictions.groupBy(*by).agg(mse.alias("mse"), F.sqrt(mse * span * span).alias("rmse"))


def total_log_loss(predictions: DataFrame, true_probability: str, by: Sequence[str] = ("part",)) -> DataFrame:
    loss = F.expr(log_loss(true_probability))
    return predictions.groupBy(*by).agg(F.sum(loss).alias("total_loss"), F.avg(loss).alias("mean_loss"))


def baseline_metrics(table: DataFrame, n_classes: int = 3) -> DataFrame:
    """Accuracy of guessing at random and of always naming the largest train class, on the test part."""
    counts = table.groupBy("cls").agg(
        F.sum(F.when(F.col("part") == "train", 1).otherwise(0)).alias("train_days"),
        F.sum(F.when(F.col("part") == "test", 1).otherwise(0)).alias("test_days"),
    )
    return counts.agg(
        F.lit(1.0 / n_classes).alias("random_accuracy"),
        (
            F.max_by("test_days", F.struct("train_days", -F.col("cls"))) / F.sum("test_days")
        ).alias("majority_accuracy"),
    )


def majority_class(table: DataFrame, keys: Sequence[str], label: str = "cls") -> DataFrame:
    """Most frequent class per group, the lowest class on ties. Class counts are summed before they meet."""
    counts = table.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("votes"))
    return counts.groupBy(*keys).agg(
        F.max_by(label, F.struct("votes", -F.col(label))).alias("majority"), F.max("votes").alias("votes")
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Rank models per task: accuracy from the top, error from the bottom, the winner marked.

    ``metrics`` has one row per task and model, so ranking a task in one group is small by nature.
    """
    better = F.when(F.col("metric") == "accuracy", -F.col("value")).otherwise(F.col("value"))
    place = F.rank().over(Window.partitionBy("task").orderBy(better))
    return metrics.withColumn("place", place).withColumn("winner", F.col("place") == 1)


def run_comparison(metrics: DataFrame, runs: Sequence[str]) -> DataFrame:
    """Metric rows of several runs side by side, one row per task and model."""
    return metrics.groupBy("task", "model", "metric").pivot("run", list(runs)).agg(F.first("value"))


def prediction_sample(
    predictions: DataFrame, names: Sequence[str], probabilities: Sequence[str] = (), size: int = 5
) -> DataFrame:
    """The first test days with a hit mark and named classes."""
    return (
        predictions.filter(F.col("part") == "test")
        .select(
            "account_id",
            "day",
            (F.col("pred") == F.col("cls")).alias("hit"),
            name_of(F.col("cls"), names).alias("actual"),
            name_of(F.col("pred"), names).alias("predicted"),
            *probabilities,
        )
        .orderBy("day", "account_id")
        .limit(size)
    )


def amount_sample(predictions: DataFrame, low: float, high: float, size: int = 5) -> DataFrame:
    """The first test days, predicted against actual amount in units."""
    return (
        predictions.filter(F.col("part") == "test")
        .select(
            "account_id",
            "day",
            (F.col("pred") * F.lit(high - low) + F.lit(low)).alias("predicted"),
            F.col("amount").alias("actual"),
        )
        .orderBy("day", "account_id")
        .limit(size)
    )


def add_metric_rows(task: str, model: str, metric: str, value: Column, source: DataFrame) -> DataFrame:
    """One metric row out of a one-row aggregate."""
    return source.agg(value.cast("double").alias("value")).select(
        F.lit(task).alias("task"), F.lit(model).alias("model"), F.lit(metric).alias("metric"), "value"
    )
