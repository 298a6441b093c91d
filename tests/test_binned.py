"""Binned fits beside the exact ones, and scoring from a model table."""

import re

import numpy as np
import pytest
from brute import boost, softmax
from pyspark.sql import functions as F

from daybook.operators.binned import Codes, fit_binned, plan_codes
from daybook.operators.boosting import BoostParams, fit_boosted
from daybook.operators.ensemble import FlatTrees, ensemble_scores, flat_tree, predict_from_table
from daybook.operators.sampling import Goss
from daybook.operators.trees import MODEL_SCHEMA, Tree
from daybook.plans.model_frame import KEYS, model_frame
from daybook.session import cut_lineage
from registry.spark_queries import X, events


@pytest.fixture(scope="module")
def frame(spark, folder):
    made = model_frame(events(spark, folder))
    made.local = made.rows.orderBy(*KEYS).toPandas()
    yield made
    made.release()


def shape(model):
    return [
        [[(i, n.feature, n.threshold if n.feature is not None else None) for i, n in sorted(t.nodes.items())] for t in group] for group in model.trees
    ]


RUNS = {
    "mse": BoostParams("amount", kind="mse", cut="observed", rounds=3, learning_rate=0.3, max_depth=3),
    "newton": BoostParams("amount", rounds=3, learning_rate=0.3, gamma=0.001),
    "leaf": BoostParams("amount", growth="leaf", rounds=2, learning_rate=0.3, num_leaves=9, min_rows=4, lam=0.1),
    "owner": BoostParams("amount", growth="oblivious", rounds=2, learning_rate=0.3, max_depth=3, lam=3.0),
    "sum": BoostParams("amount", growth="oblivious", rounds=2, learning_rate=0.3, max_depth=3, level_gain="sum"),
    "classes": BoostParams(rounds=2, learning_rate=0.3, lam=2.0),
}


@pytest.mark.parametrize("kind", RUNS)
def test_few_values_give_the_exact_trees(frame, kind):
    """With a bin per value the trees are those of the exact search."""
    params = RUNS[kind]
    exact = fit_boosted(frame.train, X, {"m": params}, KEYS)[0]["m"]
    binned = fit_binned(frame.train, X, {"m": params}, max_bins=1000)[0]["m"]
    assert shape(binned) == shape(exact)
    for a, b in zip(binned.trees, exact.trees):
        for x, y in zip(a, b):
            assert all(abs(n.value - y.nodes[i].value) < 1e-9 for i, n in x.nodes.items() if n.is_leaf)


def test_many_rounds_equal_numpy(spark, frame):
    """More rounds than are written at once; scored from the table read back."""
    rows = frame.local
    x, train, y = rows[list(X)].to_numpy(dtype=float), (rows["part"] == "train").to_numpy(), rows["y"].to_numpy()
    params = BoostParams("amount", rounds=23, learning_rate=0.2, max_depth=2)
    models, curve = fit_binned(frame.train, X, {"m": params}, curve_every=1, max_bins=1000)
    errors = [value for _, _, _, value in curve]
    assert len(errors) == 23 and all(b <= a + 1e-12 for a, b in zip(errors, errors[1:]))
    want = boost(params, x[train], y[train], x)[:, 0]
    assert abs(errors[-1] - ((want[train] - y[train]) ** 2).mean()) < 1e-9
    table = cut_lineage(models["m"].sums_table(spark)).rows
    for most in (1 << 20, 20):  # in one pass and in many
        got = predict_from_table(frame.rows, table, X, "amount", most_nodes=most)
        assert got.columns == [*frame.rows.columns, "pred"]
        assert np.allclose(want, got.orderBy(*KEYS).toPandas()["pred"], atol=1e-9)


def test_classes_from_the_table(spark, frame):
    rows = frame.local
    x, train, cls = rows[list(X)].to_numpy(dtype=float), (rows["part"] == "train").to_numpy(), rows["cls"].to_numpy()
    params = BoostParams(rounds=12, learning_rate=0.3, lam=2.0, gamma=0.01)
    model = fit_binned(frame.train, X, {"m": params}, max_bins=1000)[0]["m"]
    got = predict_from_table(frame.rows, model.sums_table(spark), X).orderBy(*KEYS).toPandas()
    assert np.allclose(softmax(boost(params, x[train], cls[train], x)), got[["p0", "p1", "p2"]], atol=1e-9)
    assert (got["pred"].to_numpy() == got[["p0", "p1", "p2"]].round(9).to_numpy().argmax(axis=1)).all()


def test_runs_share_passes_and_may_stop_apart(frame):
    runs = {"a": BoostParams("amount", rounds=2, lam=1.0), "b": BoostParams("amount", rounds=4, lam=5.0, learning_rate=0.3)}
    both, curve = fit_binned(frame.train, X, runs, curve_every=2, max_bins=1000)
    assert [(r, n) for r, n, _, _ in curve] == [("a", 2), ("b", 2), ("b", 4)]
    for run, params in runs.items():
        assert shape(both[run]) == shape(fit_binned(frame.train, X, {run: params}, max_bins=1000)[0][run])


def test_codes_of_many_values(spark):
    rows = spark.range(5000).selectExpr("double(id) AS many", "double(id % 7) AS few", "CASE WHEN id % 3 > 0 THEN double(id) END AS gaps", "1D AS one")
    codes = plan_codes(rows, ["many", "few", "gaps", "one"], 50)
    assert 40 <= len(codes.high[0]) <= 50 and codes.high[1].tolist() == list(range(7)) and codes.high[3].tolist() == [1.0]
    assert all((low <= high).all() for low, high in zip(codes.low, codes.high))
    assert (codes.low[0][1:] - codes.high[0][:-1] == 1).all() and codes.low[0][0] == 0 and codes.high[0][-1] == 4999
    coded = codes.code(np.array([[0.0, 4999.0], [3.0, 6.0], [np.nan, 1.0], [1.0, 1.0]]))
    assert coded[0].tolist() == [0, 3, len(codes.high[2]), 0] and coded[1][0] == len(codes.high[0]) - 1
    with pytest.raises(ValueError):
        plan_codes(rows, ["few"], 1 << 16)


def test_nulls_go_right(spark):
    rows = spark.range(200).selectExpr("id", "CASE WHEN id % 2 = 0 THEN double(id) END AS x", "double(id % 2) * 5 + id / 1000D AS y")
    params = BoostParams("amount", rounds=3, learning_rate=1.0, max_depth=2, lam=0.0)
    model = fit_binned(rows, ["x"], {"m": params})[0]["m"]
    table = model.sums_table(spark)
    got = predict_from_table(rows, table, ["x"], "amount").orderBy("id").toPandas()
    assert got["pred"].notna().all() and got["pred"][1::2].nunique() == 1


def test_flat_trees_walk_like_case_expressions(spark):
    tree = Tree()
    tree.split(1, 0, 0.5, 1.0, 2, 3)
    tree.split(3, 1, 2.0, 1.0, 6, 7)
    for i, v in ((2, 1.0), (6, 2.0), (7, 4.0)):
        tree.nodes[i].value = v
    rows = spark.createDataFrame([(0.5, 9.0), (0.6, 2.0), (0.6, 2.1), (None, 1.0), (0.6, None), (float("nan"), 3.0)], "a double, b double")
    want = [r[0] for r in rows.selectExpr(f"{tree.value(['a', 'b'])} AS v").collect()]
    single = Tree()
    single.nodes[1].value = 8.0
    trees = FlatTrees.of([flat_tree(tree), flat_tree(single)], [0, 1])
    inputs = np.array([[0.5, 0.6, 0.6, np.nan, 0.6, np.nan], [9.0, 2.0, 2.1, 1.0, np.nan, 3.0]])
    scores = np.zeros((2, 6))
    trees.add_to(scores, inputs)
    assert scores[0].tolist() == want and scores[1].tolist() == [8.0] * 6


def test_tables_that_do_not_fit(spark):
    rows = spark.createDataFrame([(1.0,)], "a double")
    empty = spark.createDataFrame([], MODEL_SCHEMA)
    assert ensemble_scores(rows, empty, ["a"], ["s"]).first().s == 0.0
    other = spark.createDataFrame([("m", 1, 0, 1, False, "b", 0.0, 2, 3, None), ("m", 1, 0, 2, True, None, None, None, None, 1.0), ("m", 1, 0, 3, True, None, None, None, None, 1.0)], MODEL_SCHEMA)
    with pytest.raises(ValueError):
        ensemble_scores(rows, other, ["a"], ["s"])
    with pytest.raises(ValueError):
        fit_binned(rows.withColumn("y", F.lit(1.0)), ["a"], {"m": BoostParams("amount", goss=Goss())})
    with pytest.raises(ValueError):
        fit_binned(rows.withColumn("y", F.lit(1.0)).limit(0), ["a"], {"m": BoostParams("amount")})
    assert Codes((np.array([1.0]),), (np.array([1.0]),)).offsets.tolist() == [0, 2]


def test_bins_of_many_values_hold_equal_shares_of_the_rows(spark):
    n = 60_000
    rows = spark.range(0, n, numPartitions=12).selectExpr(
        f"double((id * 7919) % {n}) AS many", f"CASE WHEN id % 3 = 0 THEN double('NaN') WHEN id % 3 = 1 THEN double(id % {n // 2}) END AS gaps"
    )
    codes = plan_codes(rows, ["many", "gaps"], 50)
    assert codes.high[0].tolist() == [n // 50 * (i + 1) - 1 for i in range(50)]
    assert codes.low[0].tolist() == [n // 50 * i for i in range(50)]
    assert len(codes.high[1]) == 50
    assert (codes.high[1][:-1] < codes.low[1][1:]).all()


def test_few_rows_are_read_by_few_tasks(spark):
    from daybook.session import TASK_ROWS, few_tasks

    rows = spark.range(0, 1000, numPartitions=40)
    assert few_tasks(rows, 1000).rdd.getNumPartitions() == 1
    assert few_tasks(rows, 3 * TASK_ROWS).rdd.getNumPartitions() == 3
    assert few_tasks(rows, 100 * TASK_ROWS).rdd.getNumPartitions() == 40
    assert few_tasks(rows, 0).count() == 1000


def test_bins_of_an_earlier_fit_are_used_again(frame, monkeypatch):
    from daybook.operators import binned

    runs = {"m": BoostParams("amount", rounds=2, lam=1.0)}
    planned = shape(fit_binned(frame.train, X, runs, max_bins=1000)[0]["m"])
    codes = plan_codes(frame.train, X, 1000)
    monkeypatch.setattr(binned, "plan_codes", None)
    assert shape(fit_binned(frame.train, X, runs, codes=codes)[0]["m"]) == planned


def test_account_fits_hold_few_rows_per_task(spark, monkeypatch):
    from daybook.operators import account_models

    rows = spark.range(0, 120).selectExpr(
        "id % 12 AS account_id", "date_add(date'2024-01-01', int(id div 12)) AS day", "IF(id < 96, 'train', 'test') AS part",
        "double(id % 5) AS x", "double(id % 7) AS y",
    )
    params = BoostParams("amount", rounds=2, max_depth=1)

    def fitted():
        return account_models.boost_by_account(rows, ["x"], params)

    whole = sorted(fitted().collect())
    monkeypatch.setattr(account_models, "TASK_ROWS", 20)
    parts = fitted()
    assert parts.rdd.getNumPartitions() == 6
    assert sorted(parts.collect()) == whole and len(whole) == 120


def test_ranged_levels_are_not_joined_and_equal_unranged_ones(spark):
    """Range totals reach the rows of a range in windows: rows grouped by their tree are not shuffled for joins."""
    import io
    from contextlib import redirect_stdout

    from daybook.operators.splits import BOUNDED, newton_criterion, oblivious_cuts, plan_ranges, unpivot_features

    draw = np.random.default_rng(9)
    rows = [(i % 2, int(draw.integers(0, 3)), float(draw.integers(0, 60)), float(draw.normal()), None if i % 50 == 0 else float(i % 7), 1.0) for i in range(800)]
    df = spark.createDataFrame(rows, "tree int, node int, a double, b double, g double, h double")
    cells = unpivot_features(df.where("g IS NOT NULL"), ["tree", "node"], ["a", "b"], {"n": "1D", "g": "g", "h": "h"})
    ranges = plan_ranges(df, ["a", "b"], wide=20, pieces=8)
    assert ranges.needed
    for level_gain in ("sum", "owner"):
        got, want = (oblivious_cuts(cells, ["tree"], "node", newton_criterion(), level_gain, r) for r in (ranges, BOUNDED))
        want = {(r["tree"], r["feature"], r["value"]): r["gain"] for r in want.collect()}
        assert {(r["tree"], r["feature"], r["value"]): pytest.approx(r["gain"], rel=1e-6, abs=1e-9) for r in got.collect()} == want
        plan = io.StringIO()
        with redirect_stdout(plan):
            got.explain()
        assert "Join" not in plan.getvalue()


def test_best_cut_of_a_level_does_not_regroup_values(frame, monkeypatch):
    """The best of all nodes' cuts is taken in the tasks that hold them; they are not shuffled again by value."""
    plans, kind = [], type(frame.train)
    collect = kind.collect

    def seen(self):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return collect(self)

    monkeypatch.setattr(kind, "collect", seen)
    fit_boosted(frame.train, X, {"m": RUNS["owner"]}, KEYS)
    assert len(plans) > RUNS["owner"].max_depth
    assert not [p for p in plans if re.search(r"hashpartitioning\(tree#\d+, feature#\d+, value#\d+", p)]
