"""Trees as small driver-side tables, and their use as column expressions.

A tree has as many nodes as its depth or leaf limit allows, never more with more data, so it is kept on the
driver while it grows. Assigning rows to nodes and scoring rows are plain ``CASE`` expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.functions.text import case, name, number

MODEL_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("class", T.IntegerType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("is_leaf", T.BooleanType()),
        T.StructField("feature", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left_id", T.LongType()),
        T.StructField("right_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@dataclass
class Node:
    stats: dict[str, float] = field(default_factory=dict)
    feature: int | None = None
    threshold: float = 0.0
    gain: float = 0.0
    left: int = 0
    right: int = 0
    value: float = 0.0

    @property
    def is_leaf(self) -> bool:
        return self.feature is None


@dataclass
class Tree:
    """Nodes by id; the root is 1. Rows with ``feature <= threshold`` go left."""

    nodes: dict[int, Node] = field(default_factory=lambda: {1: Node()})

    def leaves(self) -> list[int]:
        return [i for i, node in self.nodes.items() if node.is_leaf]

    def split(self, node_id: int, feature: int, cut: float, gain: float, left: int, right: int) -> None:
        node = self.nodes[node_id]
        node.feature, node.threshold, node.gain = feature, cut, gain
        node.left, node.right = left, right
        self.nodes[left] = Node()
        self.nodes[right] = Node()

    def settle(self, leaf_value: Callable[[dict[str, float]], float]) -> None:
        for node in self.nodes.values():
            if node.is_leaf:
                node.value = leaf_value(node.stats)

    def walk(self, features: Sequence[str], at_leaf: Callable[[int], str], node_id: int = 1) -> str:
        """One expression text with ``at_leaf(id)`` in place of every leaf."""
        node = self.nodes[node_id]
        if node.is_leaf:
            return at_leaf(node_id)
        test = f"{name(features[node.feature])} <= {number(node.threshold)}"
        left, right = (self.walk(features, at_leaf, child) for child in (node.left, node.right))
        return case([(test, left)], right)

    def value(self, features: Sequence[str]) -> str:
        return self.walk(features, lambda i: number(self.nodes[i].value))

    def leaf_id(self, features: Sequence[str], only: set[int] | None = None) -> str:
        """The leaf a row falls into; null for leaves outside ``only``."""
        text = self.walk(features, lambda i: str(i) if only is None or i in only else "NULL")
        return f"bigint({text})"

    def rows(self, features: Sequence[str], model: str, round_no: int = 0, cls: int = 0) -> list[tuple]:
        table = []
        for i, node in sorted(self.nodes.items()):
            if node.is_leaf:
                table.append((model, round_no, cls, i, True, None, None, None, None, float(node.value)))
            else:
                table.append(
                    (model, round_no, cls, i, False, features[node.feature], float(node.threshold),
                     node.left, node.right, None)
                )
        return table


def model_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, MODEL_SCHEMA)
