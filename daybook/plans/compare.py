"""Fitting many models on one frame and setting their results side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.binned import fit_binned, plan_codes
from daybook.operators.boosting import BoostParams, fit_boosted
from daybook.operators.daily import truncate_features
from daybook.operators.dense import dense_net_classify, dense_net_regress, linear_by_gradient, perceptron_by_classes, perceptron_regress
from daybook.operators.ensemble import predict_from_table
from daybook.operators.evaluate import run_comparison
from daybook.operators.knn import knn_by_account
from daybook.operators.linear import (
    forest_regress,
    library_forest_classify,
    library_tree,
    linear_regress,
    logistic_classify,
    perceptron_classify,
)
from daybook.operators.single_tree import forest_classify, tree_classify, tree_regress
from daybook.plans.model_frame import KEYS, ModelFrame, encoded_frame
from daybook.plans.presets import (
    KNN_NEIGHBOURS,
    LIBRARY_CLASSIFIERS,
    LIBRARY_FOREST,
    LIBRARY_NETS,
    LIBRARY_REGRESSORS,
    OWN_CLASSIFIERS,
    OWN_FOREST,
    OWN_REGRESSORS,
    TREE_DEPTH,
)
from daybook.session import cut_lineage, few_tasks

#: Bins per feature of the library runs.
BINS = 4096
#: Fits that send their jobs side by side: a fit is a chain of short jobs.
FITS_AT_ONCE = 4
METRICS_SCHEMA = "task string, model string, metric string, value double"


def side_by_side(spark: SparkSession, fits: Sequence[Callable]) -> list:
    """The results of independent fits, in their order."""
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fit)) for fit in fits]]


def test_accuracy(predictions: DataFrame) -> float:
    row = predictions.filter(F.col("part") == "test").agg(F.expr("avg(double(pred = cls))")).first()
    return float(row[0])


def test_rmse(predictions: DataFrame, frame: ModelFrame) -> float:
    low, high = frame.bounds["amount"]
    row = predictions.filter(F.col("part") == "test").agg(F.expr("avg(pow(pred - y, 2))")).first()
    return float(row[0]) ** 0.5 * (high - low)


def _shorter(params: BoostParams, rounds: int | None) -> BoostParams:
    return params if rounds is None else BoostParams(**{**params.__dict__, "rounds": rounds})


def compare_models(
    spark: SparkSession,
    frame: ModelFrame,
    rounds: int | None = None,
    epochs: int | None = None,
    classifiers: dict[str, BoostParams] = OWN_CLASSIFIERS,
    regressors: dict[str, BoostParams] = OWN_REGRESSORS,
    nets: bool = True,
) -> DataFrame:
    """Fit every model and return one metric row each. ``rounds`` and ``epochs`` shorten the runs."""
    features, count = frame.features, frame.kept.count()
    train, rows = few_tasks(frame.train, count), few_tasks(frame.rows, count)
    limit = {} if epochs is None else {"epochs": epochs}
    steps = {} if epochs is None else {"iterations": epochs}

    def boosted(model: str, params: BoostParams) -> DataFrame:
        fitted, _ = fit_boosted(train, features, {model: _shorter(params, rounds)}, KEYS)
        return fitted[model].predict(rows)

    fits = [
        ("class", "tree", lambda: tree_classify(train, features, max_depth=TREE_DEPTH).predict(rows)),
        ("class", "forest", lambda: forest_classify(train, features, KEYS, **OWN_FOREST).predict(rows)),
        ("class", "neighbours", lambda: knn_by_account(frame.rows, features, KNN_NEIGHBOURS)),
        ("class", "logistic", lambda: logistic_classify(train, features).predict(rows)),
        ("amount", "tree", lambda: tree_regress(train, features, max_depth=TREE_DEPTH).predict(rows)),
        ("amount", "linear", lambda: linear_regress(train, features).predict(rows)),
        ("amount", "forest", lambda: forest_regress(train, features).predict(rows)),
        *[("class", model, lambda m=model, p=params: boosted(m, p)) for model, params in classifiers.items()],
        *[("amount", model, lambda m=model, p=params: boosted(m, p)) for model, params in regressors.items()],
    ]
    if nets:
        fits += [
            ("class", "dense", lambda: dense_net_classify(train, features, **limit).predict(rows, features)),
            ("class", "perceptron", lambda: perceptron_classify(train, features, **steps).predict(rows)),
            ("amount", "dense", lambda: dense_net_regress(train, features, **limit).predict(rows, features)),
        ]

    def measured(task: str, model: str, fit: Callable[[], DataFrame]) -> tuple[str, str, str, float]:
        if task == "class":
            return task, model, "accuracy", test_accuracy(fit())
        return task, model, "rmse", test_rmse(fit(), frame)

    results = side_by_side(spark, [lambda entry=entry: measured(*entry) for entry in fits])
    return spark.createDataFrame(results, METRICS_SCHEMA)


def sweep(
    spark: SparkSession, frame: ModelFrame, runs: dict[str, BoostParams], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Test accuracy per setting. All settings are fitted in the same jobs and scored in one pass."""
    models, _ = fit_boosted(frame.train, frame.features, runs, keys)
    scored = frame.test
    for i, model in enumerate(models.values()):
        scored = model.predict(scored).withColumnRenamed("pred", f"pred_{i}").drop("p0", "p1", "p2")
    hits = [F.expr(f"avg(double(pred_{i} = cls))").alias(f"a{i}") for i in range(len(models))]
    row = scored.agg(*hits).first()
    table = [("class", run, "accuracy", float(row[f"a{i}"])) for i, run in enumerate(models)]
    return spark.createDataFrame(table, METRICS_SCHEMA)


CLASS_MODELS = ("neighbours", "tree", "forest", "logistic", "dense", "boosted", "newton", "leafwise", "oblivious")
AMOUNT_MODELS = ("linear", "tree", "forest", "dense", "boosted", "newton", "leafwise", "oblivious")


def truncated_frame(table: DataFrame, label: str) -> ModelFrame:
    """The frame of the library's category run: features cut to whole numbers, weekday and month encoded by ``label``."""
    return encoded_frame(truncate_features(table), label)


def own_against_library(
    spark: SparkSession,
    frame: ModelFrame,
    models: Sequence[str] | None = None,
    rounds: int | None = None,
    epochs: int | None = None,
) -> DataFrame:
    """Test accuracy (classes) and error in units (amounts) of own and library runs side by side, one row per task and model.

    A model that has only a library run has a null as its own one. ``models`` names those of both tasks to be run. The
    library's boosted classes by categories are fitted on whole numbers with encoded categories.
    """
    features, count = frame.features, frame.kept.count()
    train, rows = few_tasks(frame.train, count), few_tasks(frame.rows, count)
    limit = {} if epochs is None else {"epochs": epochs}
    steps = {} if epochs is None else {"iterations": epochs}

    def boosted(presets, model):
        fitted, _ = fit_boosted(train, features, {model: _shorter(presets[model], rounds)}, KEYS)
        return fitted[model].predict(rows)

    planning = Lock()

    @cache
    def planned(goal: str):
        return plan_codes(train.filter(F.col(goal).isNotNull()), features, BINS)

    def codes_of(goal: str):
        with planning:
            return planned(goal)

    def binned(presets, model, used=None):
        params = _shorter(presets[model], rounds)
        codes = codes_of("cls" if params.task == "class" else "y") if used is None else None
        fitted, _ = fit_binned(train if used is None else used.train, features, {model: params}, max_bins=BINS, codes=codes)
        return predict_from_table(rows if used is None else used.rows, fitted[model].sums_table(spark), features, params.task)

    def by_categories():
        used = truncated_frame(frame.kept, "cls")
        kept = cut_lineage(used.rows)
        return binned(LIBRARY_CLASSIFIERS, "oblivious", ModelFrame(kept.rows, used.bounds, used.features, used.kept))

    class_fits = {
        "neighbours": (
            lambda: knn_by_account(frame.rows, features, KNN_NEIGHBOURS, "manhattan"),
            lambda: knn_by_account(frame.rows, features, KNN_NEIGHBOURS, "euclidean"),
        ),
        "tree": (
            lambda: tree_classify(train, features, max_depth=TREE_DEPTH).predict(rows),
            lambda: library_tree(train, features, max_depth=TREE_DEPTH).predict(rows),
        ),
        "forest": (
            lambda: forest_classify(train, features, KEYS, **OWN_FOREST).predict(rows),
            lambda: library_forest_classify(
                train, features, n_trees=LIBRARY_FOREST["n_trees"], max_depth=LIBRARY_FOREST["max_depth"]
            ).predict(rows),
        ),
        "logistic": (None, lambda: logistic_classify(train, features).predict(rows)),
        "dense": (
            lambda: dense_net_classify(train, features, **limit).predict(rows, features),
            lambda: perceptron_by_classes(train, features, KEYS, hidden=LIBRARY_NETS["class"], **steps).predict(rows, features),
        ),
        **{
            model: (lambda m=model: boosted(OWN_CLASSIFIERS, m), lambda m=model: binned(LIBRARY_CLASSIFIERS, m))
            for model in OWN_CLASSIFIERS
        },
    }
    class_fits["oblivious"] = (class_fits["oblivious"][0], by_categories)
    amount_fits = {
        "linear": (
            lambda: linear_by_gradient(train, features, **limit).predict(rows, features),
            lambda: linear_regress(train, features).predict(rows),
        ),
        "tree": (
            lambda: tree_regress(train, features, max_depth=TREE_DEPTH).predict(rows),
            lambda: library_tree(train, features, as_class=False, max_depth=TREE_DEPTH).predict(rows),
        ),
        "forest": (None, lambda: forest_regress(train, features).predict(rows)),
        "dense": (
            lambda: dense_net_regress(train, features, **limit).predict(rows, features),
            lambda: perceptron_regress(train, features, KEYS, hidden=LIBRARY_NETS["amount"], **steps).predict(rows, features),
        ),
        **{
            model: (lambda m=model: boosted(OWN_REGRESSORS, m), lambda m=model: binned(LIBRARY_REGRESSORS, m))
            for model in OWN_REGRESSORS
        },
    }
    fits = [
        (task, model, metric, run, measure, fit)
        for task, metric, names, fits, measure in (
            ("class", "accuracy", CLASS_MODELS, class_fits, test_accuracy),
            ("amount", "rmse", AMOUNT_MODELS, amount_fits, lambda predictions: test_rmse(predictions, frame)),
        )
        for model in names
        if models is None or model in models
        for run, fit in zip(("own", "library"), fits[model])
        if fit is not None
    ]
    values = side_by_side(spark, [lambda measure=measure, fit=fit: measure(fit()) for *_, measure, fit in fits])
    results = [(*entry[:4], value) for entry, value in zip(fits, values)]
    metrics = spark.createDataFrame(results, "task string, model string, metric string, run string, value double")
    return run_comparison(metrics, ["own", "library"])
