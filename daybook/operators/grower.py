"""Growing trees by Spark jobs: one job per level for all trees that grow together.

Trees of one boosting round (one per class), of a forest, or of a parameter sweep do not depend on each
other, so the tree number is just another grouping column. What returns to the driver is one row per open
node, bounded by the size of the model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import case, name, number
from daybook.operators.splits import (
    Criterion,
    Ranges,
    best_cut,
    gini_criterion,
    mse_criterion,
    newton_criterion,
    node_cuts,
    oblivious_cuts,
    split_cuts,
    with_gain,
)
from daybook.operators.trees import Tree


@dataclass
class Plan:
    """How one tree is to grow: its row statistics and the rows it sees (as expression text), and its limits.

    ``only`` are the positions of the features that it may split on.
    """

    stats: dict[str, str]
    where: str | None = None
    only: tuple[int, ...] | None = None
    max_depth: int = 3
    num_leaves: int = 15
    min_rows: int = 1
    lam: float = 1.0
    gamma: float = 0.0


def leaf_of(kind: str, lam: float = 1.0, n_classes: int = 3) -> Callable[[dict[str, float]], float]:
    """Leaf value from the leaf's statistics: majority class, mean, or Newton step."""

    def majority(stats):
        counts = [stats.get(f"c{k}", 0.0) for k in range(n_classes)]
        return float(counts.index(max(counts)))

    def mean(stats):
        return stats["s"] / stats["n"] if stats.get("n") else 0.0

    def step(stats):
        weight = stats.get("h", 0.0) + lam
        return -stats["g"] / weight if stats.get("n") and weight else 0.0

    return {"gini": majority, "mse": mean, "newton": step}[kind]


def _per_tree(plans: Sequence[Plan], pick: Callable[[Plan], float]) -> str:
    """A plan setting as expression text, a constant where all trees agree."""
    values = [number(pick(p)) for p in plans]
    if len(set(values)) == 1:
        return values[0]
    return case([(f"tree = {tree}", value) for tree, value in enumerate(values)])


def criterion_of(kind: str, plans: Sequence[Plan], n_classes: int = 3) -> Criterion:
    if kind == "gini":
        return gini_criterion(n_classes)
    if kind == "mse":
        return mse_criterion()
    return newton_criterion(_per_tree(plans, lambda p: p.lam), _per_tree(plans, lambda p: p.gamma))


class Grower:
    """Grows trees over one cached frame of train rows."""

    def __init__(
        self,
        rows: DataFrame,
        features: Sequence[str],
        kind: str,
        cut: str,
        ranges: Ranges | None = None,
        n_classes: int = 3,
    ):
        self.rows = rows
        self.features = tuple(features)
        self.kind = kind
        self.cut = cut
        self.ranges = ranges
        self.n_classes = n_classes

    def _node_rows(self, plans: Sequence[Plan], nodes: dict[int, str]) -> DataFrame:
        """Rows times trees: the node each row is in and its statistics; rows of closed nodes are gone.

        The arrays are never empty; the outer form keeps Spark from testing their size, which would compute
        every node expression twice.
        """
        entries = []
        for tree, node in nodes.items():
            plan = plans[tree]
            seen = node if plan.where is None else case([(plan.where, node)])
            stats = [f"'{s}', double({c})" for s, c in plan.stats.items()]
            entries.append(f"named_struct({', '.join([f"'tree', {tree}", f"'node', {seen}", *stats])})")
        inputs = ", ".join(name(f) for f in self.features)
        rows = self.rows.selectExpr(f"array({inputs}) AS __inputs", f"array({', '.join(entries)}) AS __trees")
        return rows.selectExpr("__inputs", "inline_outer(__trees)").filter("node IS NOT NULL")

    def _cells(self, plans: Sequence[Plan], nodes: dict[int, str], stats: Sequence[str]) -> DataFrame:
        rows = self._node_rows(plans, nodes)
        cells = rows.selectExpr("tree", "node", "posexplode_outer(__inputs) AS (feature, value)", *stats)
        if all(plans[t].only is None for t in nodes):
            return cells
        masks = [(f"tree = {t}", f"feature IN ({', '.join(map(str, plans[t].only))})") for t in nodes if plans[t].only is not None]
        return cells.filter(case(masks, "TRUE"))

    def _find(self, plans: Sequence[Plan], trees: Sequence[Tree], ids: dict[int, set[int]]) -> dict[tuple[int, int], dict]:
        """The best cut of each node of ``ids``, with the node's totals; ``gain`` is null where no cut is allowed."""
        return self._search(plans, {t: trees[t].leaf_id(self.features, nodes) for t, nodes in ids.items()})

    def _search(self, plans: Sequence[Plan], nodes: dict[int, str]) -> dict[tuple[int, int], dict]:
        criterion = criterion_of(self.kind, plans, self.n_classes)
        cells = self._cells(plans, nodes, criterion.stats)
        minimum = _per_tree(plans, lambda p: p.min_rows)
        cuts = with_gain(split_cuts(cells, ["tree", "node"], criterion, self.ranges), criterion, minimum)
        # One row per node and feature: grouped as the running sums are, so it needs no further shuffle.
        per_feature = cuts.withColumn("column", F.col("feature"))
        best = best_cut(per_feature, ["tree", "node", "column"], criterion.stats).collect()
        found: dict[tuple[int, int], dict] = {}
        for r in sorted(best, key=lambda r: r["column"]):
            seen = found.get((r["tree"], r["node"]))
            if seen is None or (r["gain"] is not None and (seen["gain"] is None or r["gain"] > seen["gain"])):
                totals = seen or r.asDict()
                found[r["tree"], r["node"]] = {
                    **r.asDict(), **{k: totals[k] for k in totals if k.startswith("t_")}
                }
        return found

    def _apply(self, tree: Tree, node_id: int, found: dict, left: int, right: int) -> None:
        value, after = found["value"], found["next_value"]
        point = value if self.cut == "observed" else (value + after) / 2
        tree.split(node_id, found["feature"], point, found["gain"], left, right)
        names = [k[2:] for k in found if k.startswith("l_")]
        tree.nodes[left].stats = {s: found[f"l_{s}"] for s in names}
        tree.nodes[right].stats = {s: found[f"t_{s}"] - found[f"l_{s}"] for s in names}

    @staticmethod
    def _set_totals(tree: Tree, node_id: int, found: dict) -> None:
        if not tree.nodes[node_id].stats:
            tree.nodes[node_id].stats = {k[2:]: v for k, v in found.items() if k.startswith("t_")}

    def _settle(self, trees: list[Tree], plans: Sequence[Plan]) -> list[Tree]:
        for tree, plan in zip(trees, plans):
            tree.settle(leaf_of(self.kind, plan.lam, self.n_classes))
        return trees

    def by_depth(self, plans: Sequence[Plan]) -> list[Tree]:
        """All nodes of a level are searched in one job; children of node i are 2i and 2i + 1."""
        trees = [Tree() for _ in plans]
        frontier = {t: {1} for t in range(len(plans))}
        depth = 0
        while frontier:
            found = self._find(plans, trees, frontier)
            following: dict[int, set[int]] = {}
            for (t, node_id), cut in found.items():
                self._set_totals(trees[t], node_id, cut)
                if depth < plans[t].max_depth and cut["gain"] is not None and cut["gain"] > 0:
                    left, right = 2 * node_id, 2 * node_id + 1
                    self._apply(trees[t], node_id, cut, left, right)
                    if depth + 1 < plans[t].max_depth:
                        following.setdefault(t, set()).update((left, right))
            frontier = following
            depth += 1
        return self._settle(trees, plans)

    def by_leaf(self, plans: Sequence[Plan]) -> list[Tree]:
        """Split the leaf with the largest gain until ``num_leaves``.

        Which leaf comes next depends on the gains of the newest two, but a job reads all rows anyway. So the
        tree is first grown as if unsearched nodes could not be split, and one job searches all unsearched
        leaves of that tree. More splits can only push known ones back, so no other node needs a search;
        the tree is final when all its leaves are searched. Jobs per tree follow its depth, not its leaves.
        """
        full = [Tree() for _ in plans]
        trees = [Tree() for _ in plans]
        searched: list[set[int]] = [set() for _ in plans]
        created = [1] * len(plans)
        pending = {t: {1} for t in range(len(plans))}
        while pending:
            found = self._find(plans, full, pending)
            for t, ids in pending.items():
                searched[t] |= ids
            for (t, node_id), cut in sorted(found.items(), key=lambda item: item[0]):
                self._set_totals(full[t], node_id, cut)
                if cut["gain"] is not None and cut["gain"] > 0:
                    left, right = created[t] + 1, created[t] + 2
                    created[t] += 2
                    self._apply(full[t], node_id, cut, left, right)
                    small = 2 * plans[t].min_rows
                    searched[t] |= {i for i in (left, right) if full[t].nodes[i].stats["n"] < small}
            following = {}
            for t in pending:
                trees[t], leaves = self._take_best_first(full[t], plans[t].num_leaves)
                open_leaves = leaves - searched[t]
                if open_leaves:
                    following[t] = open_leaves
            pending = following
        return self._settle(trees, plans)

    @staticmethod
    def _take_best_first(full: Tree, num_leaves: int) -> tuple[Tree, set[int]]:
        """The tree of the first ``num_leaves - 1`` known splits by gain, and its leaves as ids of ``full``."""
        tree = Tree()
        tree.nodes[1].stats = full.nodes[1].stats
        source = {1: 1}  # leaf of the grown tree -> node of the full tree
        last = 1
        while len(source) < num_leaves:
            splittable = [i for i, old in source.items() if not full.nodes[old].is_leaf]
            if not splittable:
                break
            pick = max(splittable, key=lambda i: (full.nodes[source[i]].gain, -i))
            origin = full.nodes[source.pop(pick)]
            left, right = last + 1, last + 2
            last += 2
            tree.split(pick, origin.feature, origin.threshold, origin.gain, left, right)
            for new, old in ((left, origin.left), (right, origin.right)):
                tree.nodes[new].stats = full.nodes[old].stats
                source[new] = old
        return tree, set(source.values())

    def by_level(self, plans: Sequence[Plan], level_gain: str = "owner") -> list[Tree]:
        """Oblivious growth: one cut per level for all nodes of the level."""
        trees = [Tree() for _ in plans]
        growing = set(range(len(plans)))
        for depth in range(max(p.max_depth for p in plans)):
            growing = {t for t in growing if depth < plans[t].max_depth}
            if not growing:
                break
            best = self._level_cuts(plans, {t: trees[t].leaf_id(self.features) for t in growing}, level_gain)
            growing &= set(best)
            for t in growing:
                cut = best[t]
                for node_id in trees[t].leaves():
                    trees[t].split(
                        node_id, cut["feature"], (cut["value"] + cut["next_value"]) / 2, cut["gain"],
                        2 * node_id, 2 * node_id + 1,
                    )
        nodes = {t: tree.leaf_id(self.features) for t, tree in enumerate(trees)}
        stats = criterion_of(self.kind, plans).stats
        sums = self._node_rows(plans, nodes).groupBy("tree", "node").agg(*[F.sum(s).alias(s) for s in stats])
        for r in sums.collect():
            trees[r["tree"]].nodes[r["node"]].stats = {s: r[s] for s in stats}
        return self._settle(trees, plans)

    def _level_cuts(self, plans, nodes, level_gain) -> dict[int, dict]:
        criterion = criterion_of(self.kind, plans)
        cells = self._cells(plans, nodes, criterion.stats)
        owner = level_gain == "owner"
        cuts = node_cuts(cells, ["tree"], "node", criterion, self.ranges) if owner else oblivious_cuts(cells, ["tree"], "node", criterion, level_gain, self.ranges)
        rank = F.struct("gain", -F.col("feature"), -F.col("value"))
        payload = ["feature", "value", "gain"]
        apart = owner or self.ranges is not None and self.ranges.needed
        if not apart:
            # Every value of the level has a row, so the next one is at hand.
            cuts = cuts.withColumn("next_value", F.expr("lead(value) OVER (PARTITION BY tree, feature ORDER BY value)"))
            payload.append("next_value")
        best = (
            cuts.filter(F.col("gain") > 0)
            .groupBy("tree")
            .agg(F.max_by(F.struct(*payload), rank).alias("cut"))
            .select("tree", "cut.*")
            .collect()
        )
        found = {r["tree"]: r.asDict() for r in best}
        if not found or not apart:
            return {t: c for t, c in found.items() if c["next_value"] is not None}
        # The cut lies halfway to the next value among the tree's rows: one reduction for all trees.
        above = []
        for t, c in found.items():
            column, seen = f"double({name(self.features[c['feature']])})", plans[t].where
            higher = f"{column} > {number(c['value'])}" + (f" AND ({seen})" if seen else "")
            above.append(F.expr(f"min({case([(higher, column)])})").alias(f"t{t}"))
        row = self.rows.agg(*above).first()
        for t, cut in found.items():
            cut["next_value"] = row[f"t{t}"]
        return {t: c for t, c in found.items() if c["next_value"] is not None}
