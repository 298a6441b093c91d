"""Dense nets with ReLU layers, trained by full-batch gradient.

An epoch is one Spark job: every task turns its rows into one gradient vector (as long as the net has weights),
the vectors are added up, and the driver takes the step. Scoring is plain column arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.classes import likeliest_class, softmax
from daybook.functions.losses import relu
from daybook.functions.text import name, number
from daybook.operators.sampling import by_hash, first_rows


@dataclass
class DenseNet:
    """Weights ``(inputs, outputs)`` and biases per layer; the last layer is linear or softmax."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]
    task: str = "class"
    losses: list[float] = field(default_factory=list)
    held_losses: list[float] = field(default_factory=list)

    @classmethod
    def seeded(cls, layers: Sequence[int], task: str, seed: int = 42, spread: float = 0.01) -> DenseNet:
        draw = np.random.default_rng(seed)
        weights = [draw.standard_normal((a, b)) * spread for a, b in zip(layers, layers[1:])]
        return cls(weights, [np.zeros(b) for b in layers[1:]], task)

    @classmethod
    def spread_evenly(cls, layers: Sequence[int], task: str, seed: int = 42) -> DenseNet:
        """Weights and biases drawn evenly from +-sqrt(6 / (inputs + outputs)) of their layer."""
        draw = np.random.default_rng(seed)
        reach = [np.sqrt(6.0 / (a + b)) for a, b in zip(layers, layers[1:])]
        weights = [draw.uniform(-r, r, (a, b)) for r, a, b in zip(reach, layers, layers[1:])]
        return cls(weights, [draw.uniform(-r, r, b) for r, b in zip(reach, layers[1:])], task)

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for w, b in zip(self.weights, self.biases) for part in (w, b)])

    def filled(self, flat: np.ndarray) -> DenseNet:
        """A net of this shape with the numbers of ``flat``."""
        weights, biases, at = [], [], 0
        for w, b in zip(self.weights, self.biases):
            weights.append(flat[at : at + w.size].reshape(w.shape))
            biases.append(flat[at + w.size : at + w.size + b.size])
            at += w.size + b.size
        return DenseNet(weights, biases, self.task)

    def loss_table(self, spark: SparkSession) -> DataFrame:
        """(epoch, loss, held_loss): the total train loss before each epoch's step, and that of held-out rows if there were any."""
        held = [*self.held_losses, *[None] * (len(self.losses) - len(self.held_losses))]
        rows = [(i, loss, other) for i, (loss, other) in enumerate(zip(self.losses, held), start=1)]
        return spark.createDataFrame(rows, "epoch int, loss double, held_loss double")

    def forward(self, rows: DataFrame, features: Sequence[str]) -> DataFrame:
        """Adds the outputs ``o0..``: probabilities for classes, one value for amounts."""
        inputs = [name(f) for f in features]
        frame, hidden = rows, []
        for depth, (w, b) in enumerate(zip(self.weights, self.biases)):
            last = depth == len(self.weights) - 1
            sums = [
                " + ".join([*(f"{x} * {number(w[i, j])}" for i, x in enumerate(inputs)), number(b[j])])
                for j in range(w.shape[1])
            ]
            prefix = "__z" if last else f"__h{depth}_"
            names = [f"{prefix}{j}" for j in range(len(sums))]
            frame = frame.selectExpr("*", *[f"{s if last else relu(s)} AS {n}" for s, n in zip(sums, names)])
            inputs = names
            hidden += names
        outputs = softmax(inputs) if self.task == "class" else inputs
        frame = frame.selectExpr("*", *[f"{o} AS o{j}" for j, o in enumerate(outputs)])
        return frame.drop(*hidden)

    def predict(self, rows: DataFrame, features: Sequence[str]) -> DataFrame:
        outputs = [f"o{j}" for j in range(self.weights[-1].shape[1])]
        scored = self.forward(rows, features)
        pred = F.expr(likeliest_class(outputs)) if self.task == "class" else F.col("o0")
        return scored.withColumn("pred", pred)


def _partial_gradients(net: DenseNet):
    """Per task: the summed gradient of all its rows, flattened layer by layer, with loss and row count last."""
    weights, biases, task = net.weights, net.biases, net.task

    def gradients(batches):
        total = np.zeros(sum(w.size + b.size for w, b in zip(weights, biases)) + 2)
        for batch in batches:
            if not len(batch):
                continue
            x, y = np.stack(batch["x"].to_numpy()), batch["y"].to_numpy()
            layers, sums = [x], []
            for depth, (w, b) in enumerate(zip(weights, biases)):
                sums.append(layers[-1] @ w + b)
                layers.append(np.maximum(sums[-1], 0) if depth < len(weights) - 1 else sums[-1])
            out = layers[-1]
            if task == "class":
                e = np.exp(out - out.max(axis=1, keepdims=True))
                p = e / e.sum(axis=1, keepdims=True)
                hot = np.zeros_like(p)
                hot[np.arange(len(y)), y.astype(int)] = 1
                loss = -np.log((p * hot).sum(axis=1) + 1e-9).sum()
                delta = p - hot
            else:
                delta = 2 * (out - y[:, None])
                loss = ((out - y[:, None]) ** 2).sum()
            pieces = []
            for depth in range(len(weights) - 1, -1, -1):
                pieces.append(np.concatenate([(layers[depth].T @ delta).ravel(), delta.sum(axis=0)]))
                if depth:
                    delta = (delta @ weights[depth].T) * (sums[depth - 1] > 0)
            total += np.concatenate([*pieces[::-1], [loss, len(y)]])
        yield pd.DataFrame({"at": np.arange(len(total)), "part": total})

    return gradients


def gradient_sums(rows: DataFrame, net: DenseNet, features: Sequence[str], target: str) -> DataFrame:
    """Summed gradient as rows ``(at, total)``; the two last positions are loss and row count."""
    inputs = F.array(*[F.col(f).cast("double") for f in features]).alias("x")
    frame = rows.select(inputs, F.col(target).cast("double").alias("y"))
    parts = frame.mapInPandas(_partial_gradients(net), "at long, part double")
    return parts.groupBy("at").agg(F.sum("part").alias("total"))


def dense_gradient_step(rows: DataFrame, net: DenseNet, features: Sequence[str], target: str) -> DataFrame:
    """The summed gradient of one step per weight: (layer, kind, row, col, total)."""
    places = []
    for depth, w in enumerate(net.weights):
        places += [(depth, "weight", i, j) for i in range(w.shape[0]) for j in range(w.shape[1])]
        places += [(depth, "bias", 0, j) for j in range(w.shape[1])]
    table = ", ".join(f"named_struct('layer', {d}, 'kind', '{k}', 'row', {i}, 'col', {j})" for d, k, i, j in places)
    sums = gradient_sums(rows, net, features, target).filter(F.col("at") < len(places))
    return sums.selectExpr(f"array({table})[at] AS place", "total").select("place.*", "total")


def fit_dense(
    train: DataFrame,
    features: Sequence[str],
    layers: Sequence[int],
    task: str = "class",
    target: str = "cls",
    learning_rate: float = 0.01,
    epochs: int = 5000,
    patience: int = 280,
    seed: int = 42,
    net: DenseNet | None = None,
) -> DenseNet:
    """Train until ``epochs``, or until the total loss has not dropped for ``patience`` epochs.

    The step uses the mean gradient of all train rows. ``net.losses`` holds the total loss per epoch.
    """
    net = net or DenseNet.seeded(layers, task, seed)
    frame = train.select(*dict.fromkeys((*features, target))).persist(StorageLevel.MEMORY_AND_DISK)
    best, waited = float("inf"), 0
    try:
        for _ in range(epochs):
            flat = np.zeros(sum(w.size + b.size for w, b in zip(net.weights, net.biases)) + 2)
            for r in gradient_sums(frame, net, features, target).collect():
                flat[r["at"]] = r["total"]
            loss, rows = flat[-2], flat[-1]
            net.losses.append(float(loss))
            at = 0
            for w, b in zip(net.weights, net.biases):
                w -= learning_rate * flat[at : at + w.size].reshape(w.shape) / rows
                at += w.size
                b -= learning_rate * flat[at : at + b.size] / rows
                at += b.size
            best, waited = (loss, 0) if loss < best else (best, waited + 1)
            if waited >= patience:
                break
    finally:
        frame.unpersist()
    return net


def dense_net_classify(train: DataFrame, features: Sequence[str], label: str = "cls", **options) -> DenseNet:
    """Inputs - 10 - 6 - 3 classes, softmax output."""
    settings = {"learning_rate": 0.01, "epochs": 5000, "patience": 280, **options}
    return fit_dense(train, features, (len(features), 10, 6, 3), "class", label, **settings)


def dense_net_regress(train: DataFrame, features: Sequence[str], target: str = "y", **options) -> DenseNet:
    """Inputs - 6 - 3 - 1, linear output."""
    settings = {"learning_rate": 0.005, "epochs": 50000, "patience": 500, **options}
    return fit_dense(train, features, (len(features), 6, 3, 1), "amount", target, **settings)


def linear_by_gradient(train: DataFrame, features: Sequence[str], target: str = "y", **options) -> DenseNet:
    """The linear model trained by gradient: a net without hidden layers."""
    settings = {"learning_rate": 0.005, "epochs": 120, "patience": 120, **options}
    return fit_dense(train, features, (len(features), 1), "amount", target, **settings)


def _loss_and_gradient(parts: DataFrame, net: DenseNet, features: Sequence[str], target: str) -> dict[bool, np.ndarray]:
    """Summed gradient, loss and row count of the train rows and of the held-out rows (``held``), in one aggregate."""
    inputs = F.array(*[F.col(f).cast("double") for f in features]).alias("x")
    frame = parts.select(inputs, F.col(target).cast("double").alias("y"), "held")
    gradients = _partial_gradients(net)

    def run(batches):
        kept = {False: [], True: []}
        for batch in batches:
            for held, rows in batch.groupby("held"):
                sums = next(iter(gradients(iter([rows]))))["part"].to_numpy()
                kept[bool(held)] = [sums if not kept[bool(held)] else kept[bool(held)][0] + sums]
        for held, sums in kept.items():
            for total in sums:
                yield pd.DataFrame({"held": held, "at": np.arange(len(total)), "part": total})

    size = len(net.flat()) + 2
    found = {False: np.zeros(size), True: np.zeros(size)}
    for held, at, total in frame.mapInPandas(run, "held boolean, at long, part double").groupBy("held", "at").agg(F.sum("part")).collect():
        found[held][at] = total
    return found


def fit_quasi_newton(
    train: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    hidden: Sequence[int],
    task: str = "amount",
    target: str = "y",
    n_classes: int = 3,
    iterations: int = 5000,
    penalty: float = 1e-4,
    held_share: float = 0.1,
    patience: int = 10,
    tolerance: float = 1e-4,
    memory: int = 10,
    seed: int = 42,
) -> DenseNet:
    """A net by limited-memory quasi-Newton steps, stopped by the loss of held-out rows.

    Exactly ``int(held_share * n)`` rows, chosen by a hash of ``keys``, are held out. A step goes along the two-loop
    product of the mean gradient with the last ``memory`` changes and is halved until the penalised mean loss drops
    enough; a trial is one aggregate over all rows, which also gives the next gradient. Training ends when the held-out
    mean loss has not dropped by ``tolerance`` for ``patience`` steps; the net of the lowest one is returned.
    """
    n = train.count()
    held = first_rows(train, {"held": by_hash(f"{seed}-held", keys, int(held_share * n), rows=n)})["held"]
    frame = train.selectExpr(*[name(c) for c in dict.fromkeys((*features, target))], f"{held} AS held").persist(StorageLevel.MEMORY_AND_DISK)
    outputs = n_classes if task == "class" else 1
    shape = DenseNet.spread_evenly((len(features), *hidden, outputs), task, seed)
    only_weights = np.concatenate([part for w, b in zip(shape.weights, shape.biases) for part in (np.ones(w.size), np.zeros(b.size))])

    def at(point: np.ndarray) -> tuple[float, np.ndarray, float]:
        sums = _loss_and_gradient(frame, shape.filled(point), features, target)
        own, other = sums[False], sums[True]
        rows = max(1.0, own[-1])
        own_penalty = penalty * only_weights * point
        loss = own[-2] / rows + 0.5 * float(own_penalty @ point)
        return loss, own[:-2] / rows + own_penalty, (other[-2] / other[-1] if other[-1] else loss)

    point = shape.flat()
    try:
        loss, gradient, held_loss = at(point)
        losses, held_losses = [loss], [held_loss]
        best, best_point, waited = held_loss, point, 0
        changes: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(iterations):
            step = -_two_loops(gradient, changes)
            slope = float(gradient @ step)
            if slope >= 0:
                changes, step, slope = [], -gradient, -float(gradient @ gradient)
            if slope > -1e-20:
                break
            share, found = 1.0, None
            while share > 1e-10:
                found = at(point + share * step)
                if found[0] <= loss + 1e-4 * share * slope:
                    break
                share, found = share / 2, None
            if found is None:
                break
            moved, turned = share * step, found[1] - gradient
            if float(moved @ turned) > 1e-12 * float(turned @ turned):
                changes = [*changes, (moved, turned)][-memory:]
            point = point + moved
            loss, gradient, held_loss = found
            losses.append(loss), held_losses.append(held_loss)
            waited = 0 if held_loss < best - tolerance * abs(best) else waited + 1
            if held_loss < best:
                best, best_point = held_loss, point
            if waited >= patience:
                break
    finally:
        frame.unpersist()
    net = shape.filled(best_point)
    net.losses, net.held_losses = [float(x) for x in losses], [float(x) for x in held_losses]
    return net


def _two_loops(gradient: np.ndarray, changes: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The gradient times the inverse second derivatives that the changes (of point, of gradient) stand for."""
    direction, shares = gradient.copy(), []
    for moved, turned in reversed(changes):
        share = float(moved @ direction) / float(moved @ turned)
        direction -= share * turned
        shares.append(share)
    if changes:
        moved, turned = changes[-1]
        direction *= float(moved @ turned) / float(turned @ turned)
    for (moved, turned), share in zip(changes, reversed(shares)):
        direction += (share - float(turned @ direction) / float(moved @ turned)) * moved
    return direction


def perceptron_regress(train: DataFrame, features: Sequence[str], keys: Sequence[str], target: str = "y", hidden: Sequence[int] = (6, 3), **options) -> DenseNet:
    """Library net for amounts."""
    return fit_quasi_newton(train, features, keys, hidden, "amount", target, **options)


def perceptron_by_classes(train: DataFrame, features: Sequence[str], keys: Sequence[str], label: str = "cls", hidden: Sequence[int] = (10, 6), **options) -> DenseNet:
    """Library net for classes, with ReLU units and a hold-out stop as its settings have them."""
    return fit_quasi_newton(train, features, keys, hidden, "class", label, **options)
