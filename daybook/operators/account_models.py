"""One model per account, for any number of accounts, in one pass over the data.

The rows of an account, at most one per calendar day, stay in one partition from the first shuffle on. Every step
of growing a tree is a window over (account, tree, node, ...): running sums give the cuts, a maximum over the node
picks one, and the row itself moves to its child. So a whole fit is a chain of sorts and windows without any further
shuffle, join or collected result, and rows that are only to be scored travel along without taking part.

An account without train rows has no model: its predictions, and probabilities, are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.classes import argmax_class, likeliest_class
from daybook.functions.losses import HESSIAN_FLOOR, newton_leaf
from daybook.functions.text import case, name, number
from daybook.operators.boosting import BoostParams
from daybook.operators.splits import (
    Criterion,
    class_stats,
    gini_criterion,
    mse_criterion,
    newton_criterion,
)
from daybook.session import cut_lineage

NODE = "account_id, tree, node"
# Rows of a task. Its sorts hold them once per feature and level, and a round is written before the next one's sorts begin.
TASK_ROWS = 50_000


def _prepare(table: DataFrame, features: Sequence[str], goal: str, trees: int) -> DataFrame:
    """Rows times trees: ``x`` the features, ``held`` 1 for rows that are only scored, ``goal`` the target."""
    inputs = ", ".join(f"double({name(f)})" for f in features)
    return table.selectExpr(
        "account_id",
        "day",
        "part",
        f"array({inputs}) AS x",
        "IF(part = 'train', 0, 1) AS held",
        f"double({name(goal)}) AS goal",
        f"explode(sequence(0, {trees - 1})) AS tree",
    )


def _next_level(rows: DataFrame, criterion: Criterion, cut: str, min_rows: int) -> DataFrame:
    """Move every row to its child where its node has a cut with a gain, else leave it."""
    group = f"{NODE}, feature"
    ordered = f"OVER (PARTITION BY {group} ORDER BY held, value"
    stats = criterion.stats
    cells = rows.selectExpr("*", "posexplode_outer(x) AS (feature, value)").selectExpr(
        "*",
        *[f"sum({s}) {ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l_{s}" for s in stats],
        *[f"sum({s}) OVER (PARTITION BY {group}) AS t_{s}" for s in stats],
        f"lead(IF(held = 0, value, NULL)) {ordered}) AS next_value",
    )
    # A cut lies after the last of equal values of the train rows.
    allowed = f"held = 0 AND next_value > value AND l_n >= {min_rows} AND t_n - l_n >= {min_rows}"
    gain = criterion.settled({s: f"l_{s}" for s in stats}, {s: f"t_{s}" for s in stats})
    point = "value" if cut == "observed" else "(value + next_value) / 2"
    gained = cells.selectExpr("*", f"{case([(allowed, gain)])} AS gain", f"{point} AS point")
    best = "max(IF(gain > 0, struct(gain, -feature AS f, -value AS v, point), NULL))"
    chosen = gained.selectExpr("*", f"{best} OVER (PARTITION BY {NODE}) AS best").filter("feature = 0")
    moved = "IF(best IS NULL, node, 2 * node + IF(x[-best.f] > best.point, 1, 0))"
    kept = [c for c in rows.columns if c != "node"]
    return chosen.selectExpr(*[name(c) for c in kept], f"{moved} AS node")


def _grow(rows: DataFrame, criterion: Criterion, depth: int, cut: str, leaf: str, min_rows: int = 1) -> DataFrame:
    """Adds ``value``, the value of the row's leaf after ``depth`` levels."""
    frame = rows.withColumn("node", F.lit(1).cast("long"))
    for _ in range(depth):
        frame = _next_level(frame, criterion, cut, min_rows)
    sums = {s: f"sum({s}) OVER (PARTITION BY {NODE})" for s in criterion.stats}
    named = frame.selectExpr("*", *[f"{e} AS leaf_{s}" for s, e in sums.items()])
    return named.selectExpr(*[name(c) for c in rows.columns], f"{leaf} AS value")


def _only_train(stats: dict[str, str]) -> list[str]:
    return [f"IF(held = 0, {e}, 0D) AS {s}" for s, e in stats.items()]


def tree_by_account(
    table: DataFrame, features: Sequence[str], task: str = "class", label: str = "cls", target: str = "y",
    max_depth: int = 3, n_classes: int = 3,
) -> DataFrame:
    """Every account's own tree with observed thresholds; adds ``pred`` for all its rows."""
    if task == "class":
        criterion, stats, goal = gini_criterion(n_classes), class_stats("goal", n_classes), label
        leaf = f"IF(leaf_n > 0, {argmax_class([f'leaf_c{k}' for k in range(n_classes)])}, NULL)"
    else:
        criterion, stats, goal = mse_criterion(), {"n": "1D", "s": "goal"}, target
        leaf = "try_divide(leaf_s, leaf_n)"
    rows = _prepare(table, features, goal, 1).selectExpr("*", *_only_train(stats))
    return _grow(rows, criterion, max_depth, "observed", leaf).selectExpr(
        "account_id", "day", "part", "value AS pred"
    )


def boost_by_account(
    table: DataFrame, features: Sequence[str], params: BoostParams, label: str = "cls", target: str = "y"
) -> DataFrame:
    """Every account's own depth-wise boosted model; scores all its rows.

    Returns (account_id, day, part, pred), and the probabilities ``p0..`` for classes.
    """
    if params.growth != "depth" or params.goss is not None:
        raise ValueError("account models grow by depth on all train rows")
    classes = params.task == "class"
    rows = _prepare(table, features, label if classes else target, params.outputs)
    if classes:
        start = f"IF(min(held) OVER (PARTITION BY account_id) = 0, ln(1D / {params.n_classes}), NULL)"
    else:
        start = "avg(IF(held = 0, goal, NULL)) OVER (PARTITION BY account_id)"
    written = cut_lineage(rows.selectExpr("*", f"{start} AS f"))
    tasks = max(1, -(-written.rows.count() // TASK_ROWS))
    frame = written.rows.repartition(tasks, "account_id")
    for number_of_round in range(1, params.rounds + 1):
        frame = _round(frame, params, classes)
        if number_of_round < params.rounds:
            older, written = written, cut_lineage(frame)
            frame = written.rows.repartition(tasks, "account_id")
            older.drop()
    return _scores(frame, params, classes)


def _probabilities(frame: DataFrame) -> DataFrame:
    """Adds ``p``: softmax over the trees of the same day."""
    day = "OVER (PARTITION BY account_id, day)"
    return (
        frame.selectExpr("*", f"exp(f - max(f) {day}) AS e").selectExpr("*", f"e / sum(e) {day} AS p").drop("e")
    )


def _round(frame: DataFrame, params: BoostParams, classes: bool) -> DataFrame:
    columns = frame.columns
    if classes:
        frame = _probabilities(frame)
        g, h = "p - IF(goal = tree, 1D, 0D)", f"greatest(p * (1D - p), {number(HESSIAN_FLOOR)})"
    else:
        g, h = "f - goal", "1D"
    if params.kind == "mse":
        criterion, stats, leaf = mse_criterion(), {"n": "1D", "s": f"-({g})"}, "try_divide(leaf_s, leaf_n)"
    else:
        criterion = newton_criterion(number(params.lam), number(params.gamma))
        stats, leaf = {"n": "1D", "g": g, "h": h}, newton_leaf("leaf_g", "leaf_h", number(params.lam))
    rows = frame.selectExpr(*columns, *_only_train(stats))
    grown = _grow(rows, criterion, params.max_depth, params.cut, leaf, params.min_rows)
    kept = [c for c in columns if c != "f"]
    return grown.selectExpr(*kept, f"f + {number(params.learning_rate)} * value AS f")


def _scores(frame: DataFrame, params: BoostParams, classes: bool) -> DataFrame:
    if not classes:
        return frame.selectExpr("account_id", "day", "part", "f AS pred")
    names = [f"p{k}" for k in range(params.n_classes)]
    wide = _probabilities(frame).groupBy("account_id", "day", "part").agg(
        *[F.expr(f"max(IF(tree = {k}, p, NULL))").alias(n) for k, n in enumerate(names)]
    )
    return wide.withColumn("pred", F.expr(f"IF(p0 IS NULL, NULL, {likeliest_class(names)})"))
