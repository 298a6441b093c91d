"""Gradient boosting with squared or softmax loss over depth-wise, leaf-wise or oblivious trees.

Scores live on the cached train frame, one column per run and class. All trees of a round use the scores at
the round's start, so the classes, and the runs of a parameter sweep, share every job of the round. Every few
rounds the frame is written to the shared folder and read back, which keeps plans short and lets a lost
executor's part be read again instead of being recomputed from the first round. Longer fits of oblivious trees by
``owner`` keep the rows in the order of every feature instead (``levels``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.classes import likeliest_class, softmax
from daybook.functions.losses import softmax_gradient, squared_gradient
from daybook.functions.text import name, number
from daybook.operators import levels
from daybook.operators.grower import Grower, Plan
from daybook.operators.sampling import Goss, goss_weights
from daybook.operators.splits import Ranges, plan_ranges
from daybook.operators.trees import Tree, model_table
from daybook.session import cut_lineage, few_tasks

WRITE_EVERY = 5


@dataclass(frozen=True)
class BoostParams:
    """One run. ``kind`` 'mse' fits means of residuals, 'newton' uses first and second derivatives."""

    task: str = "class"
    kind: str = "newton"
    growth: str = "depth"
    cut: str = "midpoint"
    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    lam: float = 1.0
    gamma: float = 0.0
    num_leaves: int = 15
    min_rows: int = 1
    goss: Goss | None = None
    level_gain: str = "owner"
    n_classes: int = 3
    seed: str = "42"

    @property
    def outputs(self) -> int:
        return self.n_classes if self.task == "class" else 1


@dataclass
class BoostedModel:
    """Start score and trees of one run; ``trees[round][class]``."""

    name: str
    params: BoostParams
    features: tuple[str, ...]
    start: float
    trees: list[list[Tree]] = field(default_factory=list)

    def table(self, spark) -> DataFrame:
        rows = [
            r
            for number, group in enumerate(self.trees, start=1)
            for cls, tree in enumerate(group)
            for r in tree.rows(self.features, self.name, number, cls)
        ]
        return model_table(spark, rows)

    def sums_table(self, spark) -> DataFrame:
        """The run as a sum of trees: the start score is round 0, leaf values carry the learning rate.

        ``ensemble.predict_from_table`` needs nothing else.
        """
        starts = [(self.name, 0, k, 1, True, None, None, None, None, self.start) for k in range(self.params.outputs)]
        rate = self.params.learning_rate
        rows = [
            (*r[:-1], None if r[-1] is None else rate * r[-1])
            for number, group in enumerate(self.trees, start=1)
            for cls, tree in enumerate(group)
            for r in tree.rows(self.features, self.name, number, cls)
        ]
        return model_table(spark, starts + rows)

    def score(self, rows: DataFrame, names: Sequence[str], rounds: int | None = None) -> DataFrame:
        """Adds the raw scores: start + learning rate times the sum of the trees.

        The tree values are first laid out as one array per output and then added up from it: Spark compiles the
        elements of an array into separate methods, so long ensembles stay compiled.
        """
        arrays = []
        for k in range(len(names)):
            values = [group[k].value(self.features) for group in self.trees[:rounds]]
            arrays.append(f"array({', '.join(values)}) AS __t{k}")
        start, rate = number(self.start), number(self.params.learning_rate)
        sums = [f"aggregate(__t{k}, {start}, (a, v) -> a + {rate} * v) AS {n}" for k, n in enumerate(names)]
        return rows.selectExpr("*", *arrays).selectExpr("*", *sums).drop(*[f"__t{k}" for k in range(len(names))])

    def predict(self, rows: DataFrame, rounds: int | None = None) -> DataFrame:
        """Adds ``pred``, and for classes the probabilities ``p0..``."""
        if self.params.task == "amount":
            return self.score(rows, ["pred"], rounds)
        names = [f"__f{k}" for k in range(self.params.outputs)]
        probabilities = [f"p{k}" for k in range(len(names))]
        scored = self.score(rows, names, rounds)
        scored = scored.selectExpr("*", *[f"{e} AS {p}" for e, p in zip(softmax(names), probabilities)])
        return scored.withColumn("pred", F.expr(likeliest_class(probabilities))).drop(*names)


def fit_boosted(
    train: DataFrame,
    features: Sequence[str],
    runs: dict[str, BoostParams],
    keys: Sequence[str],
    label: str = "cls",
    target: str = "y",
    curve_every: int = 0,
    ranges: Ranges | None = None,
) -> tuple[dict[str, BoostedModel], list[tuple[str, int, str, float]]]:
    """Fit all runs side by side. Returns the models and the training curve ``(run, round, metric, value)``.

    The curve holds the train error or accuracy at the end of every ``curve_every``-th round.
    """
    _check(runs)
    features = tuple(features)
    first = next(iter(runs.values()))
    goal = label if first.task == "class" else target
    frame = train.select(*dict.fromkeys((*keys, *features, goal)))
    start, count, distinct = _start(frame, runs, goal, features)
    models = {run: BoostedModel(run, p, features, start[run]) for run, p in runs.items()}
    if count and ranges is None and not curve_every and levels.suits(runs) and max(p.rounds for p in runs.values()) > WRITE_EVERY:
        for run, trees in levels.fit_levels(few_tasks(frame, count), features, keys, goal, runs, start, count).items():
            models[run].trees += trees
        return models, []
    ranges = ranges or plan_ranges(frame, features, distinct=distinct)
    columns = {
        run: [f"f{i}_{k}" for k in range(p.outputs)] for i, (run, p) in enumerate(runs.items())
    }
    frame = few_tasks(frame, count).withColumns(
        {c: F.lit(start[run]) for run, group in columns.items() for c in group}
    ).persist(StorageLevel.MEMORY_AND_DISK)
    cached, written = frame, None
    curve: list[tuple[str, int, str, float]] = []
    try:
        for number_of_round in range(1, max(p.rounds for p in runs.values()) + 1):
            active = {run: p for run, p in runs.items() if number_of_round <= p.rounds}
            frame = _round(frame, features, models, active, columns, keys, goal, number_of_round, count, ranges)
            if number_of_round % WRITE_EVERY == 0 and any(number_of_round < p.rounds for p in runs.values()):
                older, written = written, cut_lineage(frame)
                frame = written.rows.persist(StorageLevel.MEMORY_AND_DISK)
                cached.unpersist()
                cached = frame
                if older is not None:
                    older.drop()
            if curve_every and number_of_round % curve_every == 0:
                curve += _curve(frame, active, columns, goal, number_of_round)
    finally:
        cached.unpersist()
        if written is not None:
            written.drop()
    return models, curve


def _check(runs: dict[str, BoostParams]) -> None:
    shared = {(p.task, p.kind, p.growth, p.cut, p.level_gain, p.n_classes) for p in runs.values()}
    if len(shared) != 1:
        raise ValueError("runs that are fitted together share task, kind, growth, cut and classes")


def _start(frame: DataFrame, runs: dict[str, BoostParams], goal: str, features: Sequence[str]):
    """Start scores, row count and distinct values per feature, from one pass."""
    row = frame.selectExpr(
        "count(1) AS n", f"avg(double({name(goal)})) AS mean",
        *[f"approx_count_distinct({name(f)}) AS d{i}" for i, f in enumerate(features)],
    ).first()
    start = {
        run: math.log(1.0 / p.n_classes) if p.task == "class" else float(row["mean"]) for run, p in runs.items()
    }
    return start, row["n"], {f: row[f"d{i}"] for i, f in enumerate(features)}


def _gradients(params: BoostParams, scores: list[str], goal: str) -> list[tuple[str, str]]:
    if params.task == "amount":
        return [squared_gradient(scores[0], name(goal))]
    return [softmax_gradient(p, name(goal), k) for k, p in enumerate(softmax(scores))]


def _round(frame, features, models, active, columns, keys, goal, number_of_round, count, ranges) -> DataFrame:
    gradients: dict[tuple[str, int], tuple[str, str]] = {}
    derived: list[str] = []
    for i, (run, params) in enumerate(active.items()):
        for k, (g, h) in enumerate(_gradients(params, columns[run], goal)):
            gradients[run, k] = (f"g{i}_{k}", f"h{i}_{k}")
            derived += [f"{g} AS g{i}_{k}", f"{h} AS h{i}_{k}"]
    graded = frame.selectExpr("*", *derived)
    weights = _weights(graded, gradients, active, keys, number_of_round, count)
    if weights:
        # Weights are comparisons of hashes; write them into the cached frame of this round once.
        drawn = [f"{weights[key]} AS w_{g}" for key, (g, _) in gradients.items() if key in weights]
        graded = graded.selectExpr("*", *drawn).persist(StorageLevel.MEMORY_AND_DISK)
    plans = [
        _plan(active[run], g, h, f"w_{g}" if (run, k) in weights else None)
        for (run, k), (g, h) in gradients.items()
    ]
    params = next(iter(active.values()))
    grower = Grower(graded, features, params.kind, params.cut, ranges)
    if params.growth == "depth":
        trees = grower.by_depth(plans)
    elif params.growth == "leaf":
        trees = grower.by_leaf(plans)
    else:
        trees = grower.by_level(plans, params.level_gain)
    if weights:
        graded.unpersist()
    updated = {}
    for (run, k), tree in zip(gradients, trees):
        if k == 0:
            models[run].trees.append([])
        models[run].trees[-1].append(tree)
        column = columns[run][k]
        updated[column] = F.expr(f"{column} + {number(active[run].learning_rate)} * {tree.value(features)}")
    return frame.withColumns(updated)


def _plan(params: BoostParams, g: str, h: str, weight: str | None) -> Plan:
    limits = dict(
        max_depth=params.max_depth, num_leaves=params.num_leaves, min_rows=params.min_rows,
        lam=params.lam, gamma=params.gamma,
    )
    if params.kind == "mse":
        return Plan({"n": "1D", "s": f"-{g}"}, **limits)
    if weight is None:
        return Plan({"n": "1D", "g": g, "h": h}, **limits)
    stats = {"n": "1D", "g": f"{g} * {weight}", "h": f"{h} * {weight}"}
    return Plan(stats, where=f"{weight} IS NOT NULL", **limits)


def _weights(graded, gradients, active, keys, number_of_round, count) -> dict[tuple[str, int], str]:
    """Sample weights of the runs that sample, found by the same passes for all of them."""
    groups: dict[tuple[Goss, str], list[tuple[str, int]]] = {}
    for run, k in gradients:
        goss = active[run].goss
        if goss is not None:
            groups.setdefault((goss, active[run].seed), []).append((run, k))
    weights = {}
    for (goss, seed), members in groups.items():
        named = {f"{run}-{k}": gradients[run, k][0] for run, k in members}
        seeds = {f"{run}-{k}": f"{seed}-{number_of_round}-{k}" for run, k in members}
        found = goss_weights(graded, named, keys, goss, seeds, count)
        weights.update({(run, k): found[f"{run}-{k}"] for run, k in members})
    return weights


def _curve(frame, active, columns, goal, number):
    metrics = {}
    for name, params in active.items():
        if params.task == "amount":
            metrics[name] = F.avg(F.pow(F.col(goal) - F.col(columns[name][0]), F.lit(2)))
        else:
            metrics[name] = F.expr(f"avg(double(({likeliest_class(softmax(columns[name]))}) = {goal}))")
    row = frame.agg(*[m.alias(f"m{i}") for i, m in enumerate(metrics.values())]).first()
    label = "mse" if next(iter(active.values())).task == "amount" else "accuracy"
    return [(name, number, label, float(row[f"m{i}"])) for i, name in enumerate(metrics)]
