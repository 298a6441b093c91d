"""Single decision trees and the hard-vote forest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.classes import argmax_class
from daybook.functions.text import name
from daybook.operators.grower import Grower, Plan
from daybook.operators.sampling import bag_samples
from daybook.operators.splits import class_stats, plan_ranges
from daybook.operators.trees import Tree, model_table


@dataclass
class TreeModel:
    """One or more trees whose leaves hold a class or an amount."""

    name: str
    features: tuple[str, ...]
    trees: list[Tree]
    task: str
    n_classes: int = 3

    def table(self, spark) -> DataFrame:
        rows = [r for t, tree in enumerate(self.trees) for r in tree.rows(self.features, self.name, t)]
        return model_table(spark, rows)

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds ``pred``: the tree's value, or the class most trees name (the lowest on ties)."""
        values = [t.value(self.features) for t in self.trees]
        if self.task == "amount":
            return rows.withColumn("pred", F.expr(f"({' + '.join(values)}) / {len(values)}"))
        if len(values) == 1:
            return rows.withColumn("pred", F.expr(f"int({values[0]})"))
        voted = rows.withColumn("__votes", F.expr(f"array({', '.join(f'int({v})' for v in values)})"))
        counts = [f"size(filter(__votes, v -> v = {k}))" for k in range(self.n_classes)]
        return voted.withColumn("pred", F.expr(argmax_class(counts))).drop("__votes")


def tree_classify(
    train: DataFrame, features: Sequence[str], label: str = "cls", max_depth: int = 3, n_classes: int = 3
) -> TreeModel:
    """Gini tree with observed values as thresholds."""
    grower = Grower(train, features, "gini", "observed", plan_ranges(train, features), n_classes)
    trees = grower.by_depth([Plan(class_stats(label, n_classes), max_depth=max_depth)])
    return TreeModel("tree", tuple(features), trees, "class", n_classes)


def tree_regress(train: DataFrame, features: Sequence[str], target: str = "y", max_depth: int = 3) -> TreeModel:
    """Squared-error tree; a leaf is the mean of its rows."""
    grower = Grower(train, features, "mse", "observed", plan_ranges(train, features))
    plan = Plan({"n": "1D", "s": name(target)}, max_depth=max_depth)
    return TreeModel("tree", tuple(features), grower.by_depth([plan]), "amount")


def forest_classify(
    train: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "cls",
    n_trees: int = 6,
    max_depth: int = 5,
    share: float = 0.8,
    seed: str = "13",
    feature_fraction: float = 1.0,
    n_classes: int = 3,
) -> TreeModel:
    """Trees on exact-size samples without replacement, all grown in the same jobs, hard vote.

    Every tree uses all features unless ``feature_fraction`` is below 1; then it draws its own subset, and the trees
    still share every job.
    """
    picks = bag_samples(train, n_trees, keys, share, seed)
    used = [name(c) for c in dict.fromkeys((*features, label))]
    frame = train.selectExpr(*used, *[f"{p} AS in_{t}" for t, p in enumerate(picks)]).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        ranges = plan_ranges(frame, features)
        subsets = [None if feature_fraction >= 1.0 else _feature_subset(features, feature_fraction, f"{seed}-{t}") for t in range(n_trees)]
        plans = [
            Plan(class_stats(label, n_classes), f"in_{t}", only, max_depth=max_depth) for t, only in enumerate(subsets)
        ]
        trees = Grower(frame, features, "gini", "observed", ranges, n_classes).by_depth(plans)
    finally:
        frame.unpersist()
    return TreeModel("forest", tuple(features), trees, "class", n_classes)


def _feature_subset(features: Sequence[str], fraction: float, seed: str) -> tuple[int, ...]:
    import hashlib

    size = max(1, int(len(features) * fraction))
    order = sorted(range(len(features)), key=lambda i: hashlib.md5(f"{seed}-{features[i]}".encode()).hexdigest())
    return tuple(sorted(order[:size]))
