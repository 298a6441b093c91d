"""Spending classes: right-closed bins of an amount, their names, and picks among class scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.text import case

# Default class edges in UAH and their names.
DEFAULT_EDGES = (0.0, 200.0, 600.0, math.inf)
DEFAULT_LABELS = ("0-200 UAH", "200-600 UAH", "600+ UAH")


def spend_class(amount: Column, edges: Sequence[float] = DEFAULT_EDGES) -> Column:
    """Index of the bin ``(edge, next edge]`` that holds the amount; null outside all bins."""
    inside = [
        (amount > low) if math.isinf(high) else (amount > low) & (amount <= high)
        for low, high in zip(edges, edges[1:])
    ]
    chain = F.when(inside[0], 0)
    for index, test in enumerate(inside[1:], start=1):
        chain = chain.when(test, index)
    return chain


def name_of(code: Column, names: Sequence[str]) -> Column:
    """The name at a small integer code; null for codes without a name."""
    chain = F.when(code == 0, names[0])
    for index, label in enumerate(names[1:], start=1):
        chain = chain.when(code == index, label)
    return chain


def argmax_class(scores: Sequence[str]) -> str:
    """Expression text: index of the largest score, the lowest index on ties."""
    if len(scores) == 1:
        return "0"
    top = f"greatest({', '.join(scores)})"
    return case([(f"({s}) = {top}", str(k)) for k, s in enumerate(scores)])


def likeliest_class(probabilities: Sequence[str]) -> str:
    """Expression text: the class of largest probability, the lowest on ties.

    Probabilities are compared to 9 digits: sums of doubles that mean the same can differ in the last bits.
    """
    return argmax_class([f"round({p}, 9)" for p in probabilities])


def softmax(scores: Sequence[str]) -> list[str]:
    """Expression texts: class probabilities, shifted by the largest score before ``exp``."""
    top = f"greatest({', '.join(scores)})" if len(scores) > 1 else scores[0]
    weights = [f"exp(({s}) - {top})" for s in scores]
    return [f"({w} / ({' + '.join(weights)}))" for w in weights]
