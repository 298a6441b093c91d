"""Fits against plain NumPy on a small fixture, and invariants of the model tables."""

from dataclasses import replace

import numpy as np
import pytest
from brute import boost, depth_tree, softmax
from pyspark.sql import functions as F

from daybook.functions.classes import likeliest_class
from daybook.operators.boosting import BoostParams, fit_boosted
from daybook.operators.sampling import Goss
from daybook.operators.single_tree import forest_classify, tree_classify, tree_regress
from daybook.operators.splits import Ranges, best_split, class_stats, gini_criterion, plan_ranges
from daybook.plans.compare import truncated_frame
from daybook.plans.model_frame import KEYS, model_frame
from registry.spark_queries import X, events


@pytest.fixture(scope="module")
def frame(spark, folder):
    made = model_frame(events(spark, folder))
    made.local = made.rows.orderBy(*KEYS).toPandas()
    yield made
    made.release()


def arrays(frame):
    rows = frame.local
    x = rows[list(X)].to_numpy(dtype=float)
    train = (rows["part"] == "train").to_numpy()
    return x, train, rows["cls"].to_numpy(), rows["y"].to_numpy()


def predicted(frame, df, columns):
    return df.orderBy(*KEYS).select(*columns).toPandas().to_numpy(dtype=float)


def test_single_trees(frame):
    x, train, cls, y = arrays(frame)
    want = depth_tree("gini", x[train], cls[train], 3)(x)
    got = predicted(frame, tree_classify(frame.train, X).predict(frame.rows), ["pred"])[:, 0]
    assert (want == got).all()
    want = depth_tree("mse", x[train], y[train], 4)(x)
    got = predicted(frame, tree_regress(frame.train, X, max_depth=4).predict(frame.rows), ["pred"])[:, 0]
    assert np.allclose(want, got, atol=1e-9)


@pytest.mark.parametrize(
    "params",
    [
        BoostParams("amount", kind="mse", cut="observed", rounds=3, learning_rate=0.3, max_depth=3),
        BoostParams("amount", rounds=3, learning_rate=0.3, gamma=0.001),
        BoostParams("amount", growth="leaf", rounds=2, learning_rate=0.3, num_leaves=9, min_rows=4, lam=0.1),
        BoostParams("amount", growth="oblivious", rounds=2, learning_rate=0.3, max_depth=3, lam=3.0),
        BoostParams("amount", growth="oblivious", rounds=2, learning_rate=0.3, max_depth=3, level_gain="sum"),
        BoostParams(rounds=2, learning_rate=0.3, lam=2.0),
    ],
    ids=["mse", "newton", "leaf", "owner", "sum", "classes"],
)
def test_boosting_equals_numpy(frame, params):
    x, train, cls, y = arrays(frame)
    goal = cls if params.task == "class" else y
    want = boost(params, x[train], goal[train], x)
    models, _ = fit_boosted(frame.train, X, {"m": params}, KEYS)
    scored = models["m"].predict(frame.rows)
    if params.task == "class":
        got = predicted(frame, scored, ["p0", "p1", "p2"])
        assert np.allclose(softmax(want), got, atol=1e-9)
        assert np.allclose(got.sum(axis=1), 1)
    else:
        assert np.allclose(want[:, 0], predicted(frame, scored, ["pred"])[:, 0], atol=1e-9)


def test_cuts_beside_an_offset(spark):
    """A small difference far from zero is a cut, whatever else the target holds; rounding of equal values is none."""
    values = [0.0] + [1 - 2e-7] * 50 + [1.0] * 50
    rows = spark.createDataFrame([(float(i), v) for i, v in enumerate(values)], "x double, y double")
    tree = tree_regress(rows, ["x"], max_depth=2).trees[0]
    assert tree.nodes[1].threshold == 0.0 and tree.nodes[3].threshold == 50.0
    equal = spark.range(1000).selectExpr("double(id) AS x", "1e9 + 0.1D AS y").repartition(7)
    assert tree_regress(equal, ["x"]).trees[0].nodes[1].is_leaf


def test_equal_probabilities_name_the_lowest_class(spark):
    rows = spark.createDataFrame([(0.1 + 0.2, 0.3, 0.1), (0.3, 0.1 + 0.2, 0.1), (0.2, 0.3, 0.3 + 1e-8)], "p0 double, p1 double, p2 double")
    assert [r[0] for r in rows.selectExpr(likeliest_class(["p0", "p1", "p2"])).collect()] == [0, 0, 2]


def test_written_rounds_do_not_change_the_fit(frame):
    """Seven rounds cross a write of the frame; the error never rises and the scores match NumPy."""
    x, train, _, y = arrays(frame)
    params = BoostParams("amount", rounds=7, learning_rate=0.3, max_depth=2)
    models, curve = fit_boosted(frame.train, X, {"m": params}, KEYS, curve_every=1)
    errors = [value for _, _, _, value in curve]
    assert all(b <= a + 1e-12 for a, b in zip(errors, errors[1:]))
    got = predicted(frame, models["m"].predict(frame.rows), ["pred"])[:, 0]
    assert np.allclose(boost(params, x[train], y[train], x)[:, 0], got, atol=1e-9)


def test_runs_share_jobs_without_mixing(frame):
    runs = {f"lam{v}": BoostParams("amount", rounds=2, learning_rate=0.3, lam=v) for v in (0.0, 5.0)}
    together, _ = fit_boosted(frame.train, X, runs, KEYS)
    for name, params in runs.items():
        alone, _ = fit_boosted(frame.train, X, {name: params}, KEYS)
        assert together[name].trees == alone[name].trees


def test_leafwise_limits(frame):
    params = BoostParams("amount", growth="leaf", rounds=1, num_leaves=7, min_rows=20, goss=None)
    models, _ = fit_boosted(frame.train, X, {"m": params}, KEYS)
    tree = models["m"].trees[0][0]
    leaves = [tree.nodes[i] for i in tree.leaves()]
    assert len(leaves) <= 7
    assert all(leaf.stats["n"] >= 20 for leaf in leaves)
    assert sum(leaf.stats["n"] for leaf in leaves) == frame.train.count()


def test_goss_tree_sees_only_the_sample(frame):
    params = BoostParams("amount", growth="leaf", rounds=1, num_leaves=4, goss=Goss())
    models, _ = fit_boosted(frame.train, X, {"m": params}, KEYS)
    tree = models["m"].trees[0][0]
    n = frame.train.count()
    assert sum(tree.nodes[i].stats["n"] for i in tree.leaves()) == int(n * 0.2) + int(n * 0.1)


def test_forest_shape_and_subset(frame):
    model = forest_classify(frame.train, X, KEYS, n_trees=3, max_depth=3)
    n = frame.train.count()
    assert [sum(t.nodes[i].stats["n"] for i in t.leaves()) for t in model.trees] == [int(n * 0.8)] * 3
    few = forest_classify(frame.train, X, KEYS, n_trees=2, max_depth=2, feature_fraction=0.34)
    for tree in few.trees:
        assert len({node.feature for node in tree.nodes.values() if not node.is_leaf}) <= 2


def test_trees_with_their_own_features_share_jobs(frame, monkeypatch):
    """One search per level for all trees; each tree is the one that grows on its features alone."""
    from daybook.operators.grower import Grower
    from daybook.operators.single_tree import _feature_subset

    searches = []
    monkeypatch.setattr(Grower, "_search", lambda self, plans, nodes, f=Grower._search: searches.append(len(nodes)) or f(self, plans, nodes))
    model = forest_classify(frame.train, X, KEYS, n_trees=3, max_depth=2, feature_fraction=0.5)
    assert searches[0] == 3 and len(searches) <= 2
    subsets = [_feature_subset(X, 0.5, f"13-{t}") for t in range(3)]
    assert len(set(subsets)) > 1
    for t, (tree, only) in enumerate(zip(model.trees, subsets)):
        assert {node.feature for node in tree.nodes.values() if not node.is_leaf} <= set(only)
        alone = forest_classify(frame.train, [X[i] for i in only], KEYS, n_trees=t + 1, max_depth=2).trees[t]
        assert [(i, n.threshold, n.value) for i, n in sorted(alone.nodes.items())] == [(i, n.threshold, n.value) for i, n in sorted(tree.nodes.items())]


def test_partitioning_does_not_matter(spark, frame):
    params = BoostParams(rounds=1, learning_rate=0.1, max_depth=2)
    tables = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (1, 7, 32):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        models, _ = fit_boosted(frame.train.repartition(parts), X, {"m": params}, KEYS)
        tables.append(
            [(r[3], r[5], r[6], None if r[9] is None else round(r[9], 9)) for g in models["m"].trees for t in g
             for r in t.rows(X, "m")]
        )
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tables[0] == tables[1] == tables[2]


def test_value_ranges_give_the_same_cuts(frame):
    train = frame.train
    stats, criterion = class_stats("cls"), gini_criterion()
    ranges = plan_ranges(train, X, wide=20, pieces=8)
    assert ranges.needed
    for by in (["part"], ["dow"]):
        plain = best_split(train, by, X, stats, criterion, "midpoint", ranges=Ranges(()))
        pieced = best_split(train, by, X, stats, criterion, "midpoint", ranges=ranges)
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, pieced.collect()))


def test_whole_fit_with_value_ranges(frame):
    ranges = plan_ranges(frame.train, X, wide=20, pieces=8)
    for params in (
        BoostParams("amount", rounds=2, max_depth=3),
        BoostParams("amount", growth="oblivious", rounds=1, max_depth=3),
        BoostParams("amount", growth="oblivious", rounds=1, max_depth=3, level_gain="sum"),
    ):
        plain, _ = fit_boosted(frame.train, X, {"m": params}, KEYS, ranges=Ranges((None,) * 6))
        pieced, _ = fit_boosted(frame.train, X, {"m": params}, KEYS, ranges=ranges)
        for a, b in zip(plain["m"].trees, pieced["m"].trees):
            assert [(r[3], r[5], r[6]) for r in a[0].rows(X, "m")] == [(r[3], r[5], r[6]) for r in b[0].rows(X, "m")]


def test_model_table(spark, frame):
    model = tree_regress(frame.train, X, max_depth=2)
    table = model.table(spark)
    assert table.filter("is_leaf").count() == len(model.trees[0].leaves())
    assert table.filter("node_id = 1 AND NOT is_leaf AND left_id = 2 AND right_id = 3").count() == 1


def test_pure_and_gainless_nodes(spark):
    pure = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 1)], "x double, cls int")
    tree = tree_classify(pure, ["x"]).trees[0]
    assert tree.leaves() == [1] and tree.nodes[1].value == 1.0
    flat = spark.createDataFrame([(1.0, 0), (1.0, 2), (1.0, 2)], "x double, cls int")
    assert tree_classify(flat, ["x"]).trees[0].nodes[1].value == 2.0
    tied = spark.createDataFrame([(1.0, 2), (1.0, 0)], "x double, cls int")
    assert tree_classify(tied, ["x"]).trees[0].nodes[1].value == 0.0
    assert tree_classify(tied, ["x"]).predict(tied).filter(F.col("pred") == 0).count() == 2


def test_all_models_own_against_library(spark, frame):
    from daybook.plans.compare import AMOUNT_MODELS, CLASS_MODELS, own_against_library

    table = {(r["task"], r["model"]): r for r in own_against_library(spark, frame, rounds=1, epochs=2).collect()}
    assert set(table) == {("class", m) for m in CLASS_MODELS} | {("amount", m) for m in AMOUNT_MODELS}
    assert {key for key, r in table.items() if r["own"] is None} == {("class", "logistic"), ("amount", "forest")}
    assert all(r["library"] is not None for r in table.values())
    for (task, _), r in table.items():
        values = [v for v in (r["own"], r["library"]) if v is not None]
        assert all(0.0 <= v <= 1.0 for v in values) if task == "class" else all(v > 0.0 for v in values)


def test_truncated_frame_encodes_whole_numbers(spark, frame):
    made = truncated_frame(frame.kept, "cls")
    rows = made.rows.toPandas()
    assert (rows["prev1"] % 1 == 0).all() and rows["dow"].nunique() > 7 and len(rows) == len(frame.local)
    made.release()


def test_small_gains_beside_an_outlier(spark):
    """One huge amount must not hide the clean cut among all others."""
    rows = [(float(i), 1e-5 if i < 50 else 2e-5) for i in range(100)] + [(100.0, 1.0)]
    frame = spark.createDataFrame(rows, "x double, y double")
    tree = tree_regress(frame, ["x"], max_depth=2).trees[0]
    assert {n.threshold for n in tree.nodes.values() if not n.is_leaf} == {99.0, 49.0}


def test_model_comparison(spark, frame):
    from daybook.plans.compare import compare_models

    table = compare_models(spark, frame, rounds=1, epochs=2).collect()
    found = {(r["task"], r["model"]) for r in table}
    boosted = {"boosted", "newton", "leafwise", "oblivious"}
    assert found == {("class", m) for m in boosted | {"tree", "forest", "neighbours", "logistic", "dense", "perceptron"}} | {
        ("amount", m) for m in boosted | {"tree", "linear", "forest", "dense"}
    }
    assert all(0.0 <= r["value"] <= 1.0 for r in table if r["task"] == "class")
    assert all(r["value"] >= 0.0 for r in table)


def test_new_days_are_scored_by_whole_fits(spark, folder, monkeypatch):
    """Both models of the query get all the rounds of their presets; here only the first of them are then run."""
    from daybook.plans import presets
    from registry import spark_queries

    asked = {}

    def few_rounds(train, features, runs, keys):
        params = runs["m"]
        asked[params.task] = params
        return fit_boosted(train, features, {"m": replace(params, rounds=1)}, keys)

    monkeypatch.setattr(spark_queries, "fit_boosted", few_rounds)
    assert spark_queries.score_new_days_fitted(spark, folder).count() > 0
    assert asked == {"class": presets.OWN_CLASSIFIERS["oblivious"], "amount": presets.OWN_REGRESSORS["oblivious"]}
    assert asked["class"].rounds == 180 and asked["amount"].rounds == 100


@pytest.mark.parametrize("task", ["class", "amount"])
def test_long_oblivious_fits_grow_the_trees_of_the_split_search(spark, monkeypatch, task):
    """In one task and in many pieces, with values that span pieces, nulls, and scores written between rounds."""
    from daybook.operators import levels

    rng = np.random.default_rng(3)
    a, b = rng.normal(size=300).round(2), rng.integers(0, 3, 300)
    y = np.sin(3 * a) + b + rng.normal(size=300) / 4
    rows = [(i // 3, i // 2, float(a[i]), float(b[i]), None if i % 11 == 0 else float(i * 7 % 60), float(y[i]), int(y[i] > 0) + int(y[i] > 1.5)) for i in range(300)]
    train = spark.createDataFrame(rows, "account_id long, day int, a double, b double, c double, y double, cls int").repartition(3)
    params = BoostParams(task, growth="oblivious", rounds=7, learning_rate=0.3, max_depth=3, lam=3.0)

    def fitted():
        return fit_boosted(train, ["a", "b", "c"], {"m": params}, KEYS)[0]["m"]

    with monkeypatch.context() as patch:
        patch.setattr(levels, "suits", lambda runs: False)
        want = fitted()
    alone = fitted()
    monkeypatch.setattr(levels, "ALONE_ROWS", 0)
    monkeypatch.setattr(levels, "PIECE_CELLS", 3 * 30)
    monkeypatch.setattr(levels, "WRITE_EVERY", 3)
    asked = []
    ask = levels.Table._ask
    monkeypatch.setattr(levels.Table, "_ask", lambda table, *rest, **only: asked.append(len(table.edges) if hasattr(table, "edges") else 0) or ask(table, *rest, **only))
    pieces = fitted()
    assert max(asked) > 20
    for got in (alone, pieces):
        assert [len(group) for group in got.trees] == [len(group) for group in want.trees]
        for tree, other in zip((t for group in got.trees for t in group), (t for group in want.trees for t in group)):
            own, others = (sorted(t.nodes.items()) for t in (tree, other))
            assert [(i, n.feature, n.threshold) for i, n in own] == [(i, n.feature, n.threshold) for i, n in others]
            assert [n.stats.get("n") for _, n in own if n.is_leaf] == [n.stats.get("n") for _, n in others if n.is_leaf]
            assert np.allclose([n.value for _, n in own], [n.value for _, n in others], atol=1e-12)
