"""Calendar columns of a date. Monday is 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names by code, Monday first.
WEEKDAY_NAMES = ("Понеділок", "Вівторок", "Середа", "Четвер", "Пятниця", "Субота", "Неділя")
WEEKDAY_NAMES_ENGLISH = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_of_week(day: Column) -> Column:
    return F.weekday(day)


def weekend(dow: Column) -> Column:
    return F.when(dow >= 5, 1).otherwise(0)


def with_calendar(df, day: str = "day"):
    """Add ``dow``, ``month`` and ``weekend``, all functions of the date alone."""
    dow = day_of_week(F.col(day))
    return df.withColumns({"dow": dow, "month": F.month(day), "weekend": weekend(dow)})
