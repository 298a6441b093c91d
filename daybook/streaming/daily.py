"""Daily totals and lags on a stream of transactions.

A day's total leaves the stream once, when the watermark has passed the end of the day. A second stream reads the
closed days and keeps the last two amounts per account. State, progress and results live below the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daybook.functions.calendar import with_calendar
from daybook.session import new_folder
from daybook.sources.statement import MONEY

CLOSED_DAY_SCHEMA = "account_id long, day date, amount double, n long"
LAGGED_DAY_SCHEMA = "account_id long, day date, amount double, n long, prev1 double, prev2 double"


def stream_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table file of a folder as a stream; the schema comes from the file, not from the data."""
    path = f"{folder}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def as_utc(ts: str) -> Column:
    """A zone-free time as the same reading in UTC, whatever the session zone: watermarks need a zoned time."""
    return F.expr(
        f"timestamp_micros(bigint(unix_date(to_date({ts}))) * 86400000000 + hour({ts}) * 3600000000L"
        f" + minute({ts}) * 60000000L + bigint(extract(SECOND FROM {ts}) * 1000000))"
    )


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Spending of the events table as a stream with a zoned time, as watermarks need one."""
    raw = stream_parquet(spark, folder, "events").filter((F.col("event_type") != "signup") & (F.col("value") > 0))
    return raw.select(
        F.col("user_id").alias("account_id"), as_utc("ts").alias("ts"),
        (-F.col("value")).cast(MONEY).alias("amount"),
    ).filter(F.col("amount") < 0)


def daily_totals(spending: DataFrame, delay: str = "1 day") -> DataFrame:
    """Closed account-days of a spending stream. Day windows are UTC days, as are zone-free source times."""
    window: Column = F.window("ts", "1 day")
    return (
        spending.withWatermark("ts", delay)
        .groupBy("account_id", window.alias("w"))
        .agg(F.sum("amount").alias("total"), F.count("amount").alias("n"))
        .select(
            "account_id",
            F.expr("date_from_unix_date(int(unix_seconds(w.start) DIV 86400))").alias("day"),
            F.abs("total").cast("double").alias("amount"),
            "n",
        )
    )


def run_to_folder(stream: DataFrame, purpose: str, target: str | None = None, progress: str | None = None) -> str:
    """Process all that is available into Parquet files and return their folder.

    With the same ``target`` and ``progress`` folders the next call goes on where the last one ended; without them
    both are new.
    """
    if (target is None) != (progress is None):
        raise ValueError("a stream goes on only with both its target and its progress folder")
    spark = stream.sparkSession
    target = target or new_folder(spark, purpose)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", progress or new_folder(spark, f"{purpose}-progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return target


def _remember_two():
    def lag_days(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """New closed days of one account in date order; the state is the last two amounts."""
        days = pd.concat(list(batches)).sort_values("day")
        last, before = state.get if state.exists else (None, None)
        prev1, prev2 = [], []
        for amount in days["amount"]:
            prev1.append(last)
            prev2.append(before)
            last, before = float(amount), last
        state.update((last, before))
        yield days.assign(prev1=pd.Series(prev1, index=days.index, dtype="float64"),
                          prev2=pd.Series(prev2, index=days.index, dtype="float64"))[
            ["account_id", "day", "amount", "n", "prev1", "prev2"]
        ]

    return lag_days


def stream_lags(closed_days: DataFrame) -> DataFrame:
    """Adds the account's two previous daily amounts. An account has one row per closed day."""
    return closed_days.groupBy("account_id").applyInPandasWithState(
        _remember_two(), LAGGED_DAY_SCHEMA, "prev1 double, prev2 double", "append", GroupStateTimeout.NoTimeout
    )


_DAY_MS = 86_400_000
_WAITING = "last double, before double, days array<long>, amounts array<double>, counts array<long>"


def _in_order():
    def lag_days(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Days of one account that the watermark has passed, in date order; the others wait in the state."""
        last, before, days, amounts, counts = state.get if state.exists else (None, None, [], [], [])
        waiting = list(zip(days, amounts, counts))
        bound = state.getCurrentWatermarkMs() // _DAY_MS  # days before this one are complete
        for batch in batches:
            for day, amount, n in zip(batch["number"].tolist(), batch["amount"].tolist(), batch["n"].tolist()):
                if day >= bound:  # an older one comes later than was allowed
                    waiting.append((int(day), float(amount), int(n)))
        waiting.sort()
        out = []
        while waiting and waiting[0][0] < bound:
            day, amount, n = waiting.pop(0)
            out.append((key[0], day, amount, n, last, before))
            last, before = amount, last
        state.update((last, before, *[list(x) for x in (zip(*waiting) if waiting else ([], [], []))]))
        if waiting:
            state.setTimeoutTimestamp(max((waiting[0][0] + 1) * _DAY_MS, state.getCurrentWatermarkMs() + 1))
        frame = pd.DataFrame(out, columns=["account_id", "number", "amount", "n", "prev1", "prev2"])
        yield frame.astype({"prev1": "float64", "prev2": "float64"})

    return lag_days


def stream_lags_in_order(closed_days: DataFrame, late_days: int = 7) -> DataFrame:
    """Adds the account's two previous daily amounts, whatever order the days come in.

    A day waits in the account's state until days that are ``late_days`` younger have been seen (the watermark), and then
    leaves in date order, when its account has new rows or by a timer. A day that comes later than that is left out. The
    state of an account is two amounts and the days that wait, at most about ``late_days`` and those of one batch.
    """
    timed = closed_days.select(
        "account_id", F.unix_date("day").cast("long").alias("number"), "amount", "n",
        F.timestamp_seconds(F.unix_date("day").cast("long") * 86400).alias("at"),
    ).withWatermark("at", f"{late_days} days")
    lagged = timed.groupBy("account_id").applyInPandasWithState(
        _in_order(), "account_id long, number long, amount double, n long, prev1 double, prev2 double", _WAITING, "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return lagged.select("account_id", F.date_from_unix_date(F.col("number").cast("int")).alias("day"), "amount", "n", "prev1", "prev2")


def stream_daily_spend(
    spark: SparkSession, folder: str, delay: str = "1 day", target: str | None = None, progress: str | None = None
) -> DataFrame:
    """Run the daily totals of the events table as a stream and return the closed days with calendar columns."""
    target = run_to_folder(daily_totals(events_stream(spark, folder), delay), "daily", target, progress)
    return with_calendar(spark.read.schema(CLOSED_DAY_SCHEMA).parquet(target))


def stream_lag_features(
    spark: SparkSession, folder: str, delay: str = "1 day", places: tuple[str, str, str, str] | None = None, late_days: int | None = None
) -> DataFrame:
    """Run both streams and return closed days with complete lags.

    ``places`` are target and progress folders of the daily and of the lag stream: with the same ones the next call goes
    on where the last one ended. With ``late_days`` days may come in any order and leave once that many younger days are
    there; without it, each batch of closed days is taken to be younger than those before.
    """
    daily_at, lags_at = (places[:2], places[2:]) if places else ((None, None), (None, None))
    days = run_to_folder(daily_totals(events_stream(spark, folder), delay), "daily", *daily_at)
    stream = spark.readStream.schema(CLOSED_DAY_SCHEMA).parquet(days)
    lagged = stream_lags(stream) if late_days is None else stream_lags_in_order(stream, late_days)
    target = run_to_folder(lagged, "lags", *lags_at)
    lagged = spark.read.schema(LAGGED_DAY_SCHEMA).parquet(target).dropna(subset=["prev1", "prev2"])
    return with_calendar(lagged)
