"""Linear models and the library models of Spark ML that serve as library runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.classes import likeliest_class, softmax
from daybook.functions.text import name, number


def _with_vector(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="__features").transform(rows)


def _predict(model, rows: DataFrame, features: Sequence[str], as_class: bool) -> DataFrame:
    scored = model.transform(_with_vector(rows, features))
    kind = "int" if as_class else "double"
    extra = [c for c in ("rawPrediction", "probability", "prediction") if c in scored.columns]
    return scored.withColumn("pred", F.col("prediction").cast(kind)).drop(*extra, "__features")


def linear_fit_1d(train: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least squares with one feature: closed form as one aggregate."""
    return train.groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    )


class FittedEstimator:
    """A Spark ML model with the ``predict`` of the other models."""

    def __init__(self, name: str, model, features: Sequence[str], as_class: bool):
        self.name, self.model, self.features, self.as_class = name, model, tuple(features), as_class

    def predict(self, rows: DataFrame) -> DataFrame:
        return _predict(self.model, rows, self.features, self.as_class)


@dataclass(frozen=True)
class LinearModel:
    """``weights`` (outputs, features) and ``biases``; outputs are an amount, or the scores of the classes."""

    name: str
    features: tuple[str, ...]
    weights: np.ndarray
    biases: np.ndarray
    steps: int = 1
    gradient: float = 0.0

    def score(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        sums = [
            " + ".join([number(b), *(f"{number(w)} * double({name(f)})" for w, f in zip(row, self.features) if w != 0.0)])
            for row, b in zip(self.weights, self.biases)
        ]
        return rows.selectExpr("*", *[f"{s} AS {n}" for s, n in zip(sums, names)])

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds ``pred``, and for classes the probabilities ``p0..``; null where a feature that counts is null."""
        if len(self.biases) == 1:
            return self.score(rows, ["pred"])
        scores, likely = [[f"{prefix}{k}" for k in range(len(self.biases))] for prefix in ("__f", "p")]
        scored = self.score(rows, scores).selectExpr("*", *[f"{e} AS {p}" for e, p in zip(softmax(scores), likely)])
        return scored.withColumn("pred", F.expr(f"IF(p0 IS NULL, NULL, {likeliest_class(likely)})")).drop(*scores)


def solve_ranked(gram: np.ndarray, right: np.ndarray, share: float = 1e-10) -> np.ndarray:
    """Solves ``gram x = right`` for a Gram matrix by a pivoted Cholesky factorisation.

    The largest remaining pivot comes first. A column of which less than ``share`` remains depends on those before it; it
    is dropped and its solution is 0.
    """
    rest, factor, order = gram.astype(float).copy(), np.zeros_like(gram, float), []
    scale = np.diag(gram).copy()
    while len(order) < len(gram):
        left = [i for i in range(len(gram)) if i not in order and rest[i, i] > share * scale[i]]
        if not left:
            break
        i = max(left, key=lambda j: (rest[j, j] / scale[j], -j))
        factor[:, len(order)] = rest[:, i] / np.sqrt(rest[i, i])
        rest -= np.outer(factor[:, len(order)], factor[:, len(order)])
        order.append(i)
    solution = np.zeros(len(gram))
    if order:
        lower = factor[order, : len(order)]
        solution[order] = np.linalg.solve(lower.T, np.linalg.solve(lower, right[order]))
    return solution


def linear_regress(train: DataFrame, features: Sequence[str], target: str = "y") -> LinearModel:
    """Ordinary least squares from two aggregates: means, then sums of products of what differs from them.

    The driver gets as many numbers as pairs of features. Constant features, and those that follow from others, have
    weight 0. Rows with a null take no part; without rows all predictions are null.
    """
    columns = [f"double({name(c)})" for c in (*features, target)]
    rows = train.selectExpr(*[f"{c} AS c{i}" for i, c in enumerate(columns)]).dropna()
    means = rows.agg(*[F.avg(f"c{i}") for i in range(len(columns))]).first()
    if means[0] is None:
        return LinearModel("linear", tuple(features), np.full((1, len(features)), np.nan), np.array([np.nan]))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    apart = [f"(c{i} - {number(m)})" for i, m in enumerate(means)]
    sums = rows.selectExpr(*[f"sum({apart[i]} * {apart[j]})" for i, j in pairs]).first()
    whole = np.zeros((len(columns), len(columns)))
    for (i, j), value in zip(pairs, sums):
        whole[i, j] = whole[j, i] = value
    weights = solve_ranked(whole[:-1, :-1], whole[-1, :-1])
    return LinearModel("linear", tuple(features), weights[None, :], np.array([means[-1] - weights @ np.array(means[:-1])]))


def _newton_sums(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """[log loss, gradient, second derivatives of each pair of classes] of the rows (x array<double>, y), in one aggregate."""
    classes, width = weights.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if not len(batch):
                continue
            x = np.column_stack([np.stack(batch["x"].to_numpy()), np.ones(len(batch))])
            hot = np.eye(classes)[batch["y"].to_numpy().astype(int)]
            scores = x @ weights.T
            scores -= scores.max(axis=1, keepdims=True)
            likely = np.exp(scores)
            sums = likely.sum(axis=1, keepdims=True)
            likely /= sums
            loss = (np.log(sums[:, 0]) - (scores * hot).sum(axis=1)).sum()
            parts = [[loss], ((likely - hot).T @ x).ravel()]
            for k in range(classes):
                for j in range(k + 1):
                    weight = likely[:, k] * ((k == j) - likely[:, j])
                    parts.append((x.T @ (x * weight[:, None])).ravel())
            part = np.concatenate(parts)
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"at": np.arange(len(total)), "part": total})

    found = rows.mapInPandas(run, "at long, part double").groupBy("at").agg(F.sum("part")).collect()
    flat = np.zeros(1 + classes * width + classes * (classes + 1) // 2 * width * width)
    for at, value in found:
        flat[at] = value
    return flat


def logistic_classify(
    train: DataFrame, features: Sequence[str], label: str = "cls", c: float = 1.0, n_classes: int = 3, tolerance: float = 1e-11, most_steps: int = 50
) -> LinearModel:
    """Multinomial logistic regression with an L2 penalty of weight 1 / (2 c) on the weights, by Newton steps.

    A step is one aggregate of gradient and second derivatives; a step that does not lower the loss is halved. It stops
    once the gradient's norm is below ``tolerance`` times the number of rows. Rows with a null take no part.
    """
    inputs = F.array(*[F.col(f).cast("double") for f in features]).alias("x")
    used = train.dropna(subset=[*features, label])
    rows = used.select(inputs, F.col(label).cast("double").alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
    width = len(features) + 1
    ridge = np.zeros((n_classes, width))
    ridge[:, :-1] = 1.0 / c
    weights = np.zeros((n_classes, width))

    def at(point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        flat = _newton_sums(rows, point)
        loss = flat[0] + 0.5 * (ridge * point * point).sum()
        gradient = flat[1 : 1 + n_classes * width] + (ridge * point).ravel()
        second = np.zeros((n_classes, width, n_classes, width))
        blocks = flat[1 + n_classes * width :].reshape(-1, width, width)
        for block, (k, j) in zip(blocks, [(k, j) for k in range(n_classes) for j in range(k + 1)]):
            second[k, :, j, :] = block
            second[j, :, k, :] = block
        return loss, gradient, second.reshape(n_classes * width, -1) + np.diag(ridge.ravel())

    try:
        count = rows.count()
        loss, gradient, second = at(weights)
        steps = 0
        while np.linalg.norm(gradient) > tolerance * max(1, count) and steps < most_steps:
            # Equal shifts of all biases change nothing: the shortest of all equal steps.
            step = np.linalg.lstsq(second, -gradient, rcond=1e-12)[0].reshape(weights.shape)
            share = 1.0
            while True:
                found = at(weights + share * step)
                if found[0] <= loss + 1e-12 * abs(loss) or share < 1e-6:
                    break
                share /= 2
            weights = weights + share * step
            loss, gradient, second = found
            steps += 1
    finally:
        rows.unpersist()
    return LinearModel("logistic", tuple(features), weights[:, :-1], weights[:, -1], steps, float(np.linalg.norm(gradient)))


def logistic_gradient(train: DataFrame, model: LinearModel, label: str = "cls", c: float = 1.0) -> DataFrame:
    """(class, feature, total): the penalised gradient at a model, by columns; ``bias`` is the last feature."""
    scored = model.predict(train.dropna(subset=[*model.features, label]))
    cells, sums = [], []
    for k, row in enumerate(model.weights):
        apart = f"(p{k} - IF({name(label)} = {k}, 1D, 0D))"
        for j, f in enumerate((*model.features, None)):
            value = f"double({name(f)})" if f else "1D"
            sums.append(f"sum({apart} * {value}) + {number(0.0 if f is None else row[j] / c)} AS g{k}_{j}")
            cells.append(f"struct({k} AS class, '{f or 'bias'}' AS feature, g{k}_{j} AS total)")
    return scored.selectExpr(*sums).selectExpr(f"inline(array({', '.join(cells)}))")


def forest_regress(
    train: DataFrame, features: Sequence[str], target: str = "y", n_trees: int = 6, max_depth: int = 10, seed: int = 13
) -> FittedEstimator:
    """Bootstrap forest over all features; a prediction is the mean of the trees."""
    estimator = RandomForestRegressor(
        featuresCol="__features", labelCol=target, numTrees=n_trees, maxDepth=max_depth,
        featureSubsetStrategy="all", seed=seed,
    )
    return FittedEstimator("forest", estimator.fit(_with_vector(train, features)), features, False)


def library_tree(
    train: DataFrame, features: Sequence[str], as_class: bool = True, target: str | None = None, max_depth: int = 3
) -> FittedEstimator:
    """Library run of the single tree. Its thresholds come from at most 255 bins per feature."""
    kind = DecisionTreeClassifier if as_class else DecisionTreeRegressor
    estimator = kind(
        featuresCol="__features", labelCol=target or ("cls" if as_class else "y"), maxDepth=max_depth, maxBins=255,
        impurity="gini" if as_class else "variance",
    )
    return FittedEstimator("tree", estimator.fit(_with_vector(train, features)), features, as_class)


def library_forest_classify(
    train: DataFrame, features: Sequence[str], label: str = "cls", n_trees: int = 20, max_depth: int = 10, seed: int = 13
) -> FittedEstimator:
    """Library run of the forest: bootstrap rows, feature subsets, averaged probabilities."""
    estimator = RandomForestClassifier(
        featuresCol="__features", labelCol=label, numTrees=n_trees, maxDepth=max_depth, seed=seed
    )
    return FittedEstimator("forest", estimator.fit(_with_vector(train, features)), features, True)


def perceptron_classify(
    train: DataFrame, features: Sequence[str], label: str = "cls", hidden: Sequence[int] = (10, 6), n_classes: int = 3,
    iterations: int = 100, seed: int = 42,
) -> FittedEstimator:
    """Library net. Its hidden units are sigmoid and it trains by L-BFGS, unlike ``dense_net_classify``."""
    estimator = MultilayerPerceptronClassifier(
        featuresCol="__features", labelCol=label, layers=[len(features), *hidden, n_classes], maxIter=iterations,
        seed=seed,
    )
    return FittedEstimator("perceptron", estimator.fit(_with_vector(train, features)), features, True)
