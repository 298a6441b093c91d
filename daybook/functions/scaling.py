"""Min-max scaling by given bounds. A constant column scales to 0; nothing is clipped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scale(value: Column, low: Column, high: Column) -> Column:
    return F.coalesce((value - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))


def unscale(value: Column, low: Column, high: Column) -> Column:
    return value * (high - low) + low
