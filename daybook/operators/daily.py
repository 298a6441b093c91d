"""From transactions to one row per account and spending day.

Only ``daily_spend`` touches transactions; its grouping is pre-aggregated in every map task, so an account
or a single day that holds a third of all rows costs one partial row per task. Everything after it works on
account-days. An account has at most one row per calendar day, which bounds every window over an account.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.calendar import with_calendar
from daybook.functions.classes import DEFAULT_EDGES, spend_class
from daybook.functions.scaling import scale, unscale

# Fixed order of the model inputs.
FEATURES = ("dow", "month", "weekend", "n", "prev1", "prev2")
TRAIN_SHARE = 0.8


def keep_spending(statement: DataFrame) -> DataFrame:
    """Spending is a negative amount."""
    return statement.filter(F.col("amount") < 0)


def daily_spend(statement: DataFrame) -> DataFrame:
    """Spent amount (positive) and number of transactions per account and day, with calendar columns."""
    totals = (
        keep_spending(statement)
        .groupBy("account_id", F.to_date("ts").alias("day"))
        .agg(F.sum("amount").alias("total"), F.count("amount").alias("n"))
    )
    return with_calendar(
        totals.select("account_id", "day", F.abs("total").cast("double").alias("amount"), "n")
    )


def lag_features(daily: DataFrame) -> DataFrame:
    """The amounts of the account's two previous spending days; rows without both are dropped."""
    by_day = Window.partitionBy("account_id").orderBy("day")
    return daily.withColumns(
        {"prev1": F.lag("amount", 1).over(by_day), "prev2": F.lag("amount", 2).over(by_day)}
    ).dropna(subset=["prev1", "prev2"])


def calendar_lag_features(daily: DataFrame) -> DataFrame:
    """The amounts of the two previous calendar days, 0 for a day without spending.

    Range frames over the day number keep this in one sort of the account's days, without a self join.
    The account's first two calendar days have no complete history and are dropped.
    """
    by_day = Window.partitionBy("account_id").orderBy("day_number")
    days_back = {
        f"prev{back}": F.coalesce(F.max("amount").over(by_day.rangeBetween(-back, -back)), F.lit(0.0))
        for back in (1, 2)
    }
    first = F.min("day_number").over(Window.partitionBy("account_id"))
    return (
        daily.withColumn("day_number", F.unix_date("day"))
        .withColumns({**days_back, "first_day": first})
        .filter(F.col("day_number") >= F.col("first_day") + 2)
        .drop("day_number", "first_day")
    )


def chronological_split(table: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """Mark the first ``int(share * n)`` days of every account ``train``, the rest ``test``."""
    account = Window.partitionBy("account_id")
    position = F.row_number().over(account.orderBy("day"))
    cut = F.floor(F.count(F.lit(1)).over(account) * F.lit(float(share)))
    return table.withColumn("part", F.when(position <= cut, "train").otherwise("test"))


def feature_table(
    statement: DataFrame,
    edges: Sequence[float] = DEFAULT_EDGES,
    lag_mode: str = "row",
    share: float = TRAIN_SHARE,
) -> DataFrame:
    """The table all learners receive: daily amount, six features, class and part.

    Two shuffles: partial sums by (account, day), then account-days by account, which all windows share.
    """
    if lag_mode not in ("row", "calendar"):
        raise ValueError("lag_mode is 'row' or 'calendar'")
    daily = daily_spend(statement)
    lagged = lag_features(daily) if lag_mode == "row" else calendar_lag_features(daily)
    return chronological_split(lagged.withColumn("cls", spend_class(F.col("amount"), edges)), share).select(
        "account_id", "day", "amount", *FEATURES, "cls", "part"
    )


def truncate_features(table: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Cut feature values to whole numbers, toward zero."""
    return table.withColumns({c: F.col(c).cast("int") for c in columns})


def class_distribution(table: DataFrame) -> DataFrame:
    return table.groupBy("part", "cls").agg(F.count(F.lit(1)).alias("days"))


def default_count(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean number of transactions per day, rounded half to even: the count assumed for a new day."""
    return table.groupBy(*keys).agg(F.bround(F.avg("n"), 0).cast("long").alias("default_n"))


def spend_summary(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("amount").alias("mean_amount"),
        F.stddev_samp("amount").alias("std_amount"),
    )


def minmax_bounds(table: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Bounds of the columns over the train rows, one row per key (one row in all without keys)."""
    bounds = [
        f(c).alias(f"{c}_{name}") for c in columns for name, f in (("min", F.min), ("max", F.max))
    ]
    return table.filter(F.col("part") == "train").groupBy(*keys).agg(*bounds)


def driver_bounds(table: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Bounds over the whole table as numbers: always one row, whatever the size of the data."""
    row = minmax_bounds(table, columns).first()
    return {c: (float(row[f"{c}_min"]), float(row[f"{c}_max"])) for c in columns}


def _account_bounds(column: str):
    train = F.when(F.col("part") == "train", F.col(column).cast("double"))
    account = Window.partitionBy("account_id")
    return F.min(train).over(account), F.max(train).over(account)


def minmax_scale(
    table: DataFrame,
    columns: Sequence[str],
    per_account: bool = True,
    bounds: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Scale columns by train bounds.

    Per account the bounds are windows over the account's days, so a table that is already partitioned by
    account is not shuffled again. Over all accounts the bounds are one driver-side row of numbers.
    """
    if per_account and bounds is None:
        scaled = {}
        for c in columns:
            low, high = _account_bounds(c)
            scaled[c] = scale(F.col(c).cast("double"), low, high)
        return table.withColumns(scaled)
    bounds = bounds or driver_bounds(table, columns)
    return table.withColumns(
        {c: scale(F.col(c).cast("double"), F.lit(bounds[c][0]), F.lit(bounds[c][1])) for c in columns}
    )


def minmax_inverse(
    table: DataFrame, scaled: Sequence[str], bounds: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Bring scaled columns back to units with a bounds table as ``minmax_bounds`` makes it."""
    joined = table.join(bounds, list(keys), "left")
    restored = {
        c: unscale(F.col(c), F.col(f"{c}_min").cast("double"), F.col(f"{c}_max").cast("double")) for c in scaled
    }
    return joined.withColumns(restored).drop(*[f"{c}_{e}" for c in scaled for e in ("min", "max")])
