"""Sums of trees scored from their model table: flat node arrays, walked for many rows at once.

The table is all there is of a fitted ensemble: its start score is a tree of one leaf in round 0, and leaf values carry
the learning rate. It can be written, read back and applied by another application.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.classes import likeliest_class, softmax
from daybook.functions.text import name
from daybook.operators.trees import Tree

#: Nodes that are sent to the tasks at once (about 22 bytes each); larger models are applied in several passes.
MOST_NODES = 1 << 20
#: Rows times trees walked at once.
_WALKED = 1 << 19


@dataclass(frozen=True)
class FlatTrees:
    """Trees as arrays over all their nodes. Children are neighbours: a row goes to ``first`` plus the bit of its test.

    A leaf has itself as its first child and no test, so all rows of all trees take the same number of steps.
    """

    roots: np.ndarray
    output: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    inner: np.ndarray
    first: np.ndarray
    value: np.ndarray
    steps: int

    @staticmethod
    def of(trees: Sequence[dict[int, tuple]], outputs: Sequence[int]) -> FlatTrees:
        """``trees`` map node ids (root 1) to (feature, threshold, left id, right id, value); a leaf has no feature."""
        roots, rows, steps = [], [], 0
        for nodes in trees:
            roots.append(len(rows))
            rows.append(None)
            level = [(1, roots[-1])]
            depth = -1
            while level:
                depth += 1
                following = []
                for node_id, at in level:
                    feature, threshold, left, right, value = nodes[node_id]
                    if feature is None:
                        rows[at] = (0, np.inf, 0, at, value)
                        continue
                    rows[at] = (feature, threshold, 1, len(rows), 0.0)
                    following += [(left, len(rows)), (right, len(rows) + 1)]
                    rows += [None, None]
                level = following
            steps = max(steps, depth)
        columns = list(zip(*rows)) if rows else [()] * 5
        return FlatTrees(
            np.array(roots, np.int32), np.array(outputs, np.int32), np.array(columns[0], np.int32), np.array(columns[1], np.float64),
            np.array(columns[2], np.int32), np.array(columns[3], np.int32), np.array(columns[4], np.float64), steps,
        )

    def leaves(self, inputs: np.ndarray) -> np.ndarray:
        """(trees, rows): the leaf of each row; ``inputs`` has a row per feature. What is not at most the threshold goes right."""
        at = np.repeat(self.roots[:, None], inputs.shape[1], axis=1)
        place = np.arange(inputs.shape[1])
        for _ in range(self.steps):
            bit = ~(inputs[self.feature[at], place] <= self.threshold[at])
            at = self.first[at] + (bit & self.inner[at].astype(bool))
        return at

    def add_to(self, scores: np.ndarray, inputs: np.ndarray) -> None:
        """Adds the trees' values to ``scores`` (outputs, rows), tree by tree."""
        step = max(1, _WALKED // max(1, len(self.roots)))
        for low in range(0, inputs.shape[1], step):
            values = self.value[self.leaves(inputs[:, low : low + step])]
            for output, row in zip(self.output, values):
                scores[output, low : low + step] += row


def flat_tree(tree: Tree, rate: float = 1.0) -> dict[int, tuple]:
    """The nodes of a grown tree as ``FlatTrees.of`` takes them."""
    return {
        i: (None, None, 0, 0, rate * node.value) if node.is_leaf else (node.feature, node.threshold, node.left, node.right, 0.0)
        for i, node in tree.nodes.items()
    }


def _blocks(table: DataFrame, most_nodes: int) -> list[tuple[int, int]]:
    """Ranges of rounds, in order, of at most ``most_nodes`` nodes; one round at least."""
    sizes = table.groupBy("round").count().orderBy("round").collect()
    blocks, held = [], 0
    for number, n in sizes:
        if not blocks or held + n > most_nodes:
            blocks.append((number, number))
            held = 0
        blocks[-1] = (blocks[-1][0], number)
        held += n
    return blocks


def _read(table: DataFrame, block: tuple[int, int], features: Sequence[str], outputs: int) -> FlatTrees:
    place = {f: i for i, f in enumerate(features)}
    trees: dict[tuple[int, int], dict[int, tuple]] = {}
    for r in table.filter(F.col("round").between(*block)).collect():
        if r["class"] is None or not 0 <= r["class"] < outputs:
            raise ValueError(f"the model has no output {r['class']}")
        if not r["is_leaf"] and r["feature"] not in place:
            raise ValueError(f"the model needs the feature {r['feature']}")
        node = (None, None, 0, 0, r["value"]) if r["is_leaf"] else (place[r["feature"]], r["threshold"], r["left_id"], r["right_id"], 0.0)
        trees.setdefault((r["round"], r["class"]), {})[r["node_id"]] = node
    order = sorted(trees)
    return FlatTrees.of([trees[key] for key in order], [cls for _, cls in order])


def _scorer(trees: FlatTrees, outputs: int):
    @F.pandas_udf("array<double>")
    def score(*columns: pd.Series) -> pd.Series:
        inputs = np.stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
        scores = np.zeros((outputs, inputs.shape[1]))
        trees.add_to(scores, inputs)
        return pd.Series(list(scores.T))

    return score


def ensemble_scores(
    rows: DataFrame, table: DataFrame, features: Sequence[str], names: Sequence[str], most_nodes: int = MOST_NODES
) -> DataFrame:
    """``rows`` plus one score per output in ``names``: the sum of the trees of ``table`` of that class, round by round.

    ``table`` has the columns of ``trees.MODEL_SCHEMA`` and one model. Its size is counted first: up to ``most_nodes`` nodes
    go to the tasks at once, a larger model in ranges of rounds, one pass over the rows each, without a shuffle. A null
    or NaN feature goes to the right of every test. Only the features cross to Python.
    """
    sums = None
    for block in _blocks(table, most_nodes):
        trees = _read(table, block, features, len(names))

        score = _scorer(trees, len(names))
        found = rows if sums is None else sums
        found = found.withColumn("__block", score(*[F.col(name(f)).cast("double") for f in features]))
        if sums is None:
            sums = found.withColumnRenamed("__block", "__sums")
        else:
            sums = found.withColumn("__sums", F.zip_with("__sums", "__block", lambda a, b: a + b)).drop("__block")
    if sums is None:
        return rows.withColumns({n: F.lit(0.0) for n in names})
    return sums.select(*[F.col(name(c)) for c in rows.columns], *[F.col("__sums")[k].alias(n) for k, n in enumerate(names)])


def predict_from_table(
    rows: DataFrame, table: DataFrame, features: Sequence[str], task: str = "class", n_classes: int = 3, most_nodes: int = MOST_NODES
) -> DataFrame:
    """Adds ``pred``, and for classes the probabilities ``p0..``, from the model table of one boosted run."""
    if task == "amount":
        return ensemble_scores(rows, table, features, ["pred"], most_nodes)
    scores = [f"__f{k}" for k in range(n_classes)]
    probabilities = [f"p{k}" for k in range(n_classes)]
    scored = ensemble_scores(rows, table, features, scores, most_nodes)
    scored = scored.selectExpr("*", *[f"{e} AS {p}" for e, p in zip(softmax(scores), probabilities)])
    return scored.withColumn("pred", F.expr(likeliest_class(probabilities))).drop(*scores)
