"""Pieces of Spark SQL expression text.

Expressions that a fit builds anew for every job are written as text and parsed once by Spark, instead of being
assembled from hundreds of Column calls.
"""

from __future__ import annotations

import math


def number(value: float) -> str:
    """A double literal that reads back exactly."""
    value = float(value)
    if math.isinf(value) or math.isnan(value):
        return f"double('{'-' if value < 0 else ''}{'Infinity' if math.isinf(value) else 'NaN'}')"
    return f"({value!r}D)" if value < 0 else f"{value!r}D"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def case(branches: list[tuple[str, str]], otherwise: str | None = None) -> str:
    body = " ".join(f"WHEN {test} THEN {value}" for test, value in branches)
    return f"CASE {body}{'' if otherwise is None else ' ELSE ' + otherwise} END"
