"""Least squares, multinomial logistic regression and quasi-Newton nets beside NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators.dense import DenseNet, _two_loops, fit_quasi_newton, linear_by_gradient, perceptron_by_classes
from daybook.operators.linear import linear_regress, logistic_classify, logistic_gradient, solve_ranked


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 4))
    x[:, 2] = 5.0  # constant
    x[:, 3] = 2 * x[:, 0] - x[:, 1]  # follows from others
    y = 1e6 + 3 * x[:, 0] - x[:, 1] + draw.normal(scale=0.1, size=400)
    cls = np.clip(np.round(x[:, 0] + draw.normal(scale=0.7, size=400)), -1, 1).astype(int) + 1
    rows = [(i, *map(float, r), float(v), int(k)) for i, (r, v, k) in enumerate(zip(x, y, cls))]
    return x, y, cls, spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, cls int").repartition(5)


X = ("a", "b", "c", "d")


def test_least_squares_with_dependent_columns(data):
    x, y, _, rows = data
    model = linear_regress(rows, X)
    fitted = np.column_stack([x, np.ones(len(x))]) @ np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]
    got = model.predict(rows).orderBy("id").toPandas()["pred"]
    assert np.allclose(got, fitted, rtol=0, atol=1e-6)
    assert (model.weights[0] == 0).sum() == 2 and model.weights[0][2] == 0


def test_least_squares_of_odd_rows(spark, data):
    *_, rows = data
    some = rows.withColumn("y", F.when(F.col("id") % 3 > 0, F.col("y")))
    whole = linear_regress(rows.filter("id % 3 > 0"), X)
    assert np.allclose(linear_regress(some, X).weights, whole.weights)
    assert linear_regress(rows.limit(0), X).predict(rows.limit(1)).first()["pred"] != 0.0
    one = linear_regress(rows.limit(1), X)
    assert (one.weights == 0).all()
    assert solve_ranked(np.zeros((2, 2)), np.zeros(2)).tolist() == [0.0, 0.0]


def test_logistic_steps_end_where_the_gradient_is_zero(data):
    x, _, cls, rows = data
    model = logistic_classify(rows, X, c=0.5)
    assert 3 <= model.steps <= 20 and model.gradient < 1e-8
    wide = np.column_stack([x, np.ones(len(x))])
    weights = np.column_stack([model.weights, model.biases])
    scores = wide @ weights.T
    likely = np.exp(scores - scores.max(axis=1, keepdims=True))
    likely /= likely.sum(axis=1, keepdims=True)
    gradient = (likely - np.eye(3)[cls]).T @ wide
    gradient[:, :-1] += model.weights / 0.5
    assert np.abs(gradient).max() < 1e-8
    by_columns = {(r["class"], r.feature): r.total for r in logistic_gradient(rows, model, c=0.5).collect()}
    assert len(by_columns) == 15 and max(map(abs, by_columns.values())) < 1e-8
    got = model.predict(rows).orderBy("id").toPandas()
    assert np.allclose(got[["p0", "p1", "p2"]], likely) and (got["pred"] == cls).mean() > 0.5
    assert set(got.columns) == {*rows.columns, "p0", "p1", "p2", "pred"}


def test_two_loops_solve_a_quadratic():
    draw = np.random.default_rng(1)
    root = draw.normal(size=(5, 5))
    second = root @ root.T + np.eye(5)
    moves = [draw.normal(size=5) for _ in range(5)]
    changes = [(m, second @ m) for m in moves]
    direction = _two_loops(second @ moves[-1], changes)
    assert np.allclose(direction, moves[-1])  # the last change is met exactly
    assert np.allclose(_two_loops(np.ones(5), []), np.ones(5))


def net_loss(net, x, y, task):
    for depth, (w, b) in enumerate(zip(net.weights, net.biases)):
        x = x @ w + b
        if depth < len(net.weights) - 1:
            x = np.maximum(x, 0)
    if task == "amount":
        return ((x[:, 0] - y) ** 2).mean()
    likely = np.exp(x - x.max(axis=1, keepdims=True))
    return -np.log((likely / likely.sum(axis=1, keepdims=True))[np.arange(len(y)), y] + 1e-9).mean()


def test_quasi_newton_net_holds_out_and_stops(spark, data):
    x, y, cls, rows = data
    scaled = rows.withColumn("y", (F.col("y") - 1e6) / 5)
    net = fit_quasi_newton(scaled, X, ["id"], (6, 3), iterations=200, patience=5)
    assert len(net.losses) == len(net.held_losses) and 5 < len(net.losses) <= 201
    assert all(b <= a + 1e-12 for a, b in zip(net.losses, net.losses[1:]))
    assert min(net.held_losses) < 0.1 * net.held_losses[0]
    assert net_loss(net, x, (y - 1e6) / 5, "amount") < 0.01
    table = net.loss_table(spark).collect()
    assert [(r.epoch, r.loss) for r in table] == list(enumerate(net.losses, 1)) and table[0].held_loss == net.held_losses[0]
    # the loss of the held-out rows is that of the rows not trained on: with all of them held out nothing is learned
    still = fit_quasi_newton(scaled, X, ["id"], (6, 3), iterations=3, held_share=1.0, penalty=0.0)
    assert len(still.losses) == 1 and still.held_losses[0] == pytest.approx(net_loss(still, x, (y - 1e6) / 5, "amount"))


def test_quasi_newton_classes(data):
    x, _, cls, rows = data
    net = perceptron_by_classes(rows, X[:2], ["id"], iterations=40)
    assert net_loss(net, x[:, :2], cls, "class") < 0.8 * np.log(3)
    got = net.predict(rows, X[:2]).orderBy("id").toPandas()
    assert (got["pred"] == cls).mean() > 0.55


def test_losses_of_the_gradient_trainer(spark, data):
    *_, rows = data
    net = linear_by_gradient(rows.withColumn("y", F.col("y") / 1e6), X, epochs=3, net=DenseNet([np.zeros((4, 1))], [np.zeros(1)], "amount"))
    table = net.loss_table(spark).orderBy("epoch").collect()
    assert [r.epoch for r in table] == [1, 2, 3] and table[0].loss > table[2].loss and table[0].held_loss is None
