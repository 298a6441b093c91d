"""Scoring requests about new days: class, class probabilities and amount from known models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.calendar import WEEKDAY_NAMES, day_of_week, weekend
from daybook.functions.classes import DEFAULT_LABELS, name_of
from daybook.functions.scaling import scale, unscale
from daybook.operators.daily import FEATURES


def next_day_requests(daily: DataFrame) -> DataFrame:
    """One request per account: the day after its last spending day, with its last two amounts."""
    latest = Window.partitionBy("account_id").orderBy(F.desc("day"))
    last = (
        daily.withColumns({"rn": F.row_number().over(latest), "before": F.lead("amount").over(latest)})
        .filter((F.col("rn") == 1) & F.col("before").isNotNull())
        .withColumn("day", F.date_add("day", 1))
    )
    return last.select(
        "account_id",
        "day",
        day_of_week(F.col("day")).alias("dow"),
        F.month("day").alias("month"),
        F.col("amount").alias("prev1"),
        F.col("before").alias("prev2"),
    )


def complete_requests(requests: DataFrame, usual_count: int) -> DataFrame:
    """Derive what a request does not hold: the weekend flag, and the usual number of transactions."""
    return requests.withColumns({"weekend": weekend(F.col("dow")), "n": F.lit(usual_count).cast("long")})


def score_new_days(
    requests: DataFrame,
    usual_count: int,
    bounds: dict[str, tuple[float, float]],
    class_model: Callable[[DataFrame], DataFrame],
    amount_model: Callable[[DataFrame], DataFrame],
    features: Sequence[str] = FEATURES,
    labels: Sequence[str] = DEFAULT_LABELS,
    encode: Callable[[DataFrame], DataFrame] | None = None,
    encode_amount: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Answer every request with the day's name, class, class name and amount in units.

    Models are functions that add ``pred`` (and ``p0..`` if they know probabilities). Features are scaled by the
    bounds the models were trained with; with ``encode`` categories are encoded instead of scaled, for the amount model by
    ``encode_amount`` where it was trained on another encoding. The amount is always brought back to units.
    """
    full = complete_requests(requests, usual_count)
    kept = [f"__raw_{c}" for c in ("dow", "month")]
    full = full.withColumns({"__raw_dow": F.col("dow"), "__raw_month": F.col("month")})
    if encode is None:
        inputs = full.withColumns(
            {f: scale(F.col(f).cast("double"), F.lit(bounds[f][0]), F.lit(bounds[f][1])) for f in features}
        )
    else:
        inputs = encode(full)
    classed = class_model(inputs).withColumnRenamed("pred", "cls")
    if encode_amount is not None:
        classed = encode_amount(classed.withColumns({c: F.col(f"__raw_{c}") for c in ("dow", "month")}))
    amounts = amount_model(classed)
    low, high = bounds["amount"]
    probabilities = [c for c in ("p0", "p1", "p2") if c in amounts.columns]
    return amounts.select(
        "account_id",
        "day",
        name_of(F.col(kept[0]), WEEKDAY_NAMES).alias("weekday_name"),
        F.col(kept[1]).alias("month"),
        "cls",
        name_of(F.col("cls"), labels).alias("cls_name"),
        *probabilities,
        unscale(F.col("pred"), F.lit(low), F.lit(high)).alias("amount"),
    )
