"""The frame learners train on: scaled features, scaled amount, class and part."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.scaling import scale
from daybook.operators.daily import FEATURES, driver_bounds, minmax_scale
from daybook.operators.encode import ordered_target_encode_pooled, target_encode

KEYS = ("account_id", "day")


@dataclass
class ModelFrame:
    """A kept feature table of all accounts with the numbers needed to go back to units."""

    rows: DataFrame
    bounds: dict[str, tuple[float, float]]
    features: tuple[str, ...]
    kept: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("part") == "train")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("part") == "test")

    def release(self) -> None:
        """Free the kept table; frames derived from it stay usable and are then computed from the source."""
        self.kept.unpersist()


def model_frame(
    table: DataFrame,
    features: Sequence[str] = FEATURES,
    scale_features: bool = True,
) -> ModelFrame:
    """Scale by bounds of all train rows; the unscaled table is kept (disk-backed) for the passes of a fit.

    The transactions are read once: bounds and all later passes come from the kept table, and scaling is
    arithmetic on top of it. Adds ``y``, the amount scaled by its train bounds; ``amount`` stays in units.
    """
    columns = tuple(features)
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    bounds = driver_bounds(table, (*columns, "amount"))
    low, high = bounds["amount"]
    frame = table.withColumn("y", scale(F.col("amount"), F.lit(low), F.lit(high)))
    if scale_features:
        frame = minmax_scale(frame, columns, per_account=False, bounds=bounds)
    else:
        frame = frame.withColumns({c: F.col(c).cast("double") for c in columns})
    return ModelFrame(frame, bounds, columns, table)


def encoded_frame(
    table: DataFrame, label: str = "cls", categories: Sequence[str] = ("dow", "month"), features: Sequence[str] = FEATURES
) -> ModelFrame:
    """The frame of the category-encoding learners: encoded categories, all other features in their own units.

    Train rows are encoded from earlier train rows only, test rows from all train rows; ``label`` is the class, or
    ``y``, the scaled amount.
    """
    frame = model_frame(table, features, scale_features=False)
    train = ordered_target_encode_pooled(frame.train, categories, label)
    test = target_encode(frame.test, frame.train, categories, label)
    rows = train.unionByName(test).withColumns({c: F.col(f"{c}_enc") for c in categories})
    return ModelFrame(rows.drop(*[f"{c}_enc" for c in categories]), frame.bounds, frame.features, frame.kept)


def encode_requests(frame: ModelFrame, label: str = "cls", categories: Sequence[str] = ("dow", "month")):
    """A function that encodes new days as ``encoded_frame`` encodes test rows. ``frame`` is unencoded and unscaled."""

    def encode(requests: DataFrame) -> DataFrame:
        encoded = target_encode(requests, frame.train, categories, label)
        return encoded.withColumns({c: F.col(f"{c}_enc") for c in categories}).drop(*[f"{c}_enc" for c in categories])

    return encode
