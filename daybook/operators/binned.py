"""Boosting on features coded once as bin numbers, with histograms of the smaller child only.

A feature of at most ``max_bins`` distinct values has a bin per value, which gives the trees of the exact search; others
have bins of about equal numbers of rows. A pass over the coded rows sums gradients per (tree, node, bin) inside the
tasks, Spark adds the tasks' sums, and the driver picks cuts from them: numbers bounded by trees, nodes and bins, whatever
the number of rows. Of two sibling nodes only the smaller is summed; the other is the parent less that one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.losses import HESSIAN_FLOOR
from daybook.functions.text import name, number
from daybook.operators.boosting import BoostedModel, BoostParams, _check
from daybook.operators.ensemble import FlatTrees, flat_tree
from daybook.operators.grower import Grower, Plan
from daybook.operators.trees import Tree
from daybook.session import cut_lineage, few_tasks

#: Rounds after which the scores so far are written to the shared folder.
WRITE_EVERY = 10


@dataclass(frozen=True)
class Codes:
    """Bins per feature: the largest and the smallest train value of each, both rising."""

    high: tuple[np.ndarray, ...]
    low: tuple[np.ndarray, ...]

    @property
    def offsets(self) -> np.ndarray:
        """First slot of each feature, and the number of slots."""
        return np.cumsum([0, *(len(h) + 1 for h in self.high)])  # the last slot of a feature is for nulls

    def code(self, inputs: np.ndarray) -> np.ndarray:
        """Bin numbers (rows, features) of raw values (features, rows); nulls are right of all values."""
        return np.stack([np.searchsorted(h, x) for h, x in zip(self.high, inputs)], axis=1).astype("<u2")

    def of_tree(self, tree: Tree, rate: float) -> dict[int, tuple]:
        """The tree over bin numbers."""
        return {
            i: node if node[0] is None else (node[0], float(np.searchsorted(self.high[node[0]], node[1], side="right") - 1), *node[2:])
            for i, node in flat_tree(tree, rate).items()
        }


def plan_codes(train: DataFrame, features: Sequence[str], max_bins: int = 255) -> Codes:
    """Bins from all train rows, read once; what comes back is at most ``max_bins`` pairs per feature.

    The rows are counted by feature and value. A feature of more distinct values is cut at equal shares of its rows: a
    value's bin follows from the rows below it, which are a running sum inside a range of values and the totals of the
    ranges before it.
    """
    if not 2 <= max_bins < 1 << 15:
        raise ValueError("max_bins must be 2 to 32,767")
    counted = cut_lineage(_value_counts(train, features))
    try:
        totals = {r["f"]: r for r in counted.rows.groupBy("f").agg(F.count("*").alias("values"), F.sum("n").alias("n")).collect()}
        wide = [f for f, r in totals.items() if r["values"] > max_bins]
        bins = counted.rows.where(~F.col("f").isin(wide)).selectExpr("f", "value AS high", "value AS low")
        found: list[list[tuple[float, float]]] = [[] for _ in features]
        for r in bins.collect():
            found[r["f"]].append((r["high"], r["low"]))
        if wide:
            whole = F.create_map(*[F.lit(x) for f in wide for x in (f, totals[f]["n"])])
            for r in _equal_shares(counted.rows.where(F.col("f").isin(wide)), whole, max_bins).collect():
                found[r["f"]].append((r["high"], r["low"]))
    finally:
        counted.drop()
    pairs = [sorted(x) for x in found]
    return Codes(tuple(np.array([h for h, _ in x], float) for x in pairs), tuple(np.array([v for _, v in x], float) for x in pairs))


def _value_counts(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """(f, value, n): rows per value of each feature, without nulls and NaN."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in range(batch.num_columns):
                values, n = np.unique(batch.column(f).drop_null().to_numpy(zero_copy_only=False), return_counts=True)
                real = ~np.isnan(values)
                values, n = values[real], n[real]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), f, np.int32)), pa.array(values), pa.array(n, pa.int64())], ["f", "value", "n"])

    rows = train.selectExpr(*[f"double({name(f)}) AS c{i}" for i, f in enumerate(features)])
    return rows.mapInArrow(run, "f int, value double, n long").groupBy("f", "value").agg(F.sum("n").alias("n"))


def _equal_shares(counted: DataFrame, whole: Column, max_bins: int) -> DataFrame:
    """(f, bin, high, low): values with equal ``max_bins``-ths of the rows below them share a bin."""
    placed = cut_lineage(counted.repartitionByRange("f", "value").withColumn("piece", F.spark_partition_id()))
    pieces = placed.rows.groupBy("f", "piece").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("f").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("n").over(Window.partitionBy("f", "piece").orderBy("value")) - F.col("n")
    below = placed.rows.withColumn("inside", inside).join(F.broadcast(pieces.select("f", "piece", before.alias("before"))), ["f", "piece"])
    bins = below.withColumn("below", F.col("before") + F.col("inside")).withColumn("whole", whole[F.col("f")])
    return bins.groupBy("f", F.expr(f"below * {max_bins} div whole").alias("bin")).agg(F.max("value").alias("high"), F.min("value").alias("low"))


class BinnedGrower(Grower):
    """Grows trees from histograms; ``sums`` gives those of some nodes of some trees."""

    def __init__(self, sums, codes: Codes, features: Sequence[str], kind: str, cut: str):
        super().__init__(None, features, kind, cut)
        self.sums, self.codes = sums, codes
        self.held: dict[tuple[int, int], np.ndarray] = {}
        self.names = ("n", "s") if kind == "mse" else ("n", "g", "h")

    def _histograms(self, plans: Sequence[Plan], trees: Sequence[Tree], ids: dict[int, set[int]]) -> None:
        """Makes ``held`` have all nodes of ``ids``."""
        asked: dict[int, list[int]] = {}
        derived = []
        for t, nodes in ids.items():
            parent = {child: i for i, node in trees[t].nodes.items() if not node.is_leaf for child in (node.left, node.right)}
            for i in sorted(nodes):
                above = parent.get(i)
                if above is None or (t, above) not in self.held:
                    asked.setdefault(t, []).append(i)
                    continue
                pair = trees[t].nodes[above]
                rows = {c: trees[t].nodes[c].stats["n"] for c in (pair.left, pair.right)}
                small = min(rows, key=lambda c: (rows[c], c))
                if rows[small] < 0.5:
                    self.held[t, small] = np.zeros_like(self.held[t, above])
                elif (t, small) not in self.held and small not in asked.get(t, ()):
                    asked.setdefault(t, []).append(small)
                if small != i:
                    derived.append((t, i, above, small))
        if asked:
            self.held.update(self.sums(plans, trees, asked))
        for t, i, above, small in derived:
            rest = self.held[t, above] - self.held[t, small]
            rest[:, rest[0] < 0.5] = 0.0  # no row, so no sum either
            self.held[t, i] = rest

    def _running(self, key: tuple[int, int]):
        """Per feature: (rows per bin, sums up to each bin, totals)."""
        hist, offsets = self.held[key], self.codes.offsets
        for f, (low, high) in enumerate(zip(offsets, offsets[1:])):
            part = hist[:, low:high]
            yield f, part[0, :-1], np.cumsum(part[:, :-1], axis=1), part.sum(axis=1)

    def _gains(self, plan: Plan, left: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gain, size) of every cut."""
        right = total[:, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            if self.kind == "mse":
                share = left[0] * right[0] / total[0] ** 2
                a, b = left[1] / left[0], right[1] / right[0]
                gain, size = share * (a - b) ** 2, 1e-10 * share * (np.abs(a) + np.abs(b)) ** 2
                return np.nan_to_num(gain), np.nan_to_num(size)
            parts = [np.nan_to_num(x[1] ** 2 / (x[2] + plan.lam), posinf=0.0) for x in (left, right)]
            weight = total[2] + plan.lam
            whole = total[1] ** 2 / weight if weight else 0.0
        size = 0.5 * (parts[0] + parts[1])
        return size - 0.5 * whole - plan.gamma, size

    @staticmethod
    def _settled(gain: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.where(gain > 1e-12 * size, gain.astype(np.float32).astype(float), 0.0)

    def _allowed(self, rows: np.ndarray, left: np.ndarray, total: np.ndarray, min_rows: float) -> np.ndarray:
        """Cuts at values of the node with enough rows on both sides."""
        followed = left[0] < rows.sum() - 0.5  # by another value, not by nulls alone
        return (rows > 0.5) & followed & (left[0] >= min_rows - 0.5) & (total[0] - left[0] >= min_rows - 0.5)

    def _next(self, f: int, rows: np.ndarray, at: int) -> float | None:
        above = np.flatnonzero(rows[at + 1 :] > 0.5)
        return float(self.codes.low[f][at + 1 + above[0]]) if len(above) else None

    def _find(self, plans, trees, ids):
        self._histograms(plans, trees, ids)
        found = {}
        for t, nodes in ids.items():
            for i in nodes:
                best = None
                for f, rows, left, total in self._running((t, i)):
                    if best is None:
                        best = {"gain": None, **{f"t_{s}": float(x) for s, x in zip(self.names, total)}}
                    ok = np.flatnonzero(self._allowed(rows, left, total, plans[t].min_rows))
                    if not len(ok):
                        continue
                    gains = self._settled(*self._gains(plans[t], left[:, ok], total))
                    at = int(ok[gains.argmax()])
                    gain = float(gains.max())
                    if best["gain"] is not None and gain <= best["gain"]:
                        continue
                    best.update(feature=f, value=float(self.codes.high[f][at]), next_value=self._next(f, rows, at), gain=gain)
                    best.update({f"l_{s}": float(x) for s, x in zip(self.names, left[:, at])})
                found[t, i] = best
        return found

    def by_level(self, plans: Sequence[Plan], level_gain: str = "owner") -> list[Tree]:
        """Oblivious growth; the leaves' sums follow from the last level's histograms."""
        trees = [Tree() for _ in plans]
        growing = set(range(len(plans)))
        for depth in range(max(p.max_depth for p in plans)):
            growing = {t for t in growing if depth < plans[t].max_depth}
            if not growing:
                break
            leaves = {t: set(trees[t].leaves()) for t in growing}
            self._histograms(plans, trees, leaves)
            for t in sorted(growing):
                cut = self._level_cut(plans[t], t, leaves[t], level_gain)
                if cut is None:
                    growing.discard(t)
                    continue
                f, at, gain, after = cut
                point = (float(self.codes.high[f][at]) + after) / 2
                for i in leaves[t]:
                    _, _, left, total = next(x for x in self._running((t, i)) if x[0] == f)
                    trees[t].split(i, f, point, gain, 2 * i, 2 * i + 1)
                    trees[t].nodes[2 * i].stats = dict(zip(self.names, left[:, at].tolist()))
                    trees[t].nodes[2 * i + 1].stats = dict(zip(self.names, (total - left[:, at]).tolist()))
        for t, tree in enumerate(trees):
            if tree.nodes[1].is_leaf:
                _, _, _, total = next(self._running((t, 1)))
                tree.nodes[1].stats = dict(zip(self.names, total.tolist()))
            for node in tree.nodes.values():
                if node.is_leaf and node.stats["n"] < 0.5:
                    node.stats = {}
        return self._settle(trees, plans)

    def _level_cut(self, plan: Plan, t: int, leaves: set[int], level_gain: str):
        """(feature, bin, gain, next value) of the level's cut, None without one."""
        best = None
        whole = sum(self.held[t, i][0] for i in leaves)
        offsets = self.codes.offsets
        level = [dict((f, (rows, left, total)) for f, rows, left, total in self._running((t, i))) for i in sorted(leaves)]
        for f, (low, high) in enumerate(zip(offsets, offsets[1:])):
            rows_all = whole[low : high - 1]
            gain = np.zeros(high - low - 1)
            size = np.zeros(high - low - 1)
            for node in level:
                rows, left, total = node[f]
                if total[0] < 0.5:
                    continue
                g, s = self._gains(plan, left, total)
                if level_gain == "owner":
                    gain = np.maximum(gain, np.where(self._allowed(rows, left, total, 1), self._settled(g, s), 0.0))
                else:
                    inside = (left[0] > 0.5) & (total[0] - left[0] > 0.5)
                    gain, size = gain + np.where(inside, g, 0.0), size + np.where(inside, s, 0.0)
            if level_gain == "sum":
                gain = np.where(rows_all > 0.5, self._settled(gain, size), 0.0)
            if not len(gain):
                continue
            at = int(gain.argmax())
            after = self._next(f, rows_all, at)
            if gain[at] > 0 and after is not None and (best is None or gain[at] > best[2]):
                best = (f, at, float(gain[at]), after)
        return best


def _coded(train: DataFrame, features: Sequence[str], goal: str, codes: Codes, starts: list[float]) -> DataFrame:
    """(codes binary, goal double, scores binary): a narrow row per train row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(features))])
            scores = np.tile(np.array(starts, "<f8"), (batch.num_rows, 1))
            yield pa.RecordBatch.from_arrays(
                [_binary(codes.code(inputs)), batch.column(len(features)), _binary(scores)], ["codes", "goal", "scores"]
            )

    rows = train.selectExpr(*[f"coalesce(double({name(f)}), double('NaN')) AS f{i}" for i, f in enumerate(features)], f"double({name(goal)}) AS goal")
    return rows.mapInArrow(run, "codes binary, goal double, scores binary")


def _binary(matrix: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    width = matrix.shape[1] * matrix.itemsize
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """(rows, width) of a column of equally long values."""
    if not len(column):
        return np.empty((0, width), dtype)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(dtype).reshape(len(column), width)


class _Rows:
    """The coded rows, and the trees that their written scores do not hold yet."""

    def __init__(self, frame: DataFrame, codes: Codes, runs: dict[str, BoostParams]):
        self.frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
        self.codes, self.runs = codes, runs
        self.outputs = [(run, k) for run, p in runs.items() for k in range(p.outputs)]
        self.waiting: list[tuple[int, dict[int, tuple]]] = []
        self.written = None

    def _opened(self):
        """A function from a batch to (codes per feature, goal, scores per output)."""
        trees = FlatTrees.of([t for _, t in self.waiting], [o for o, _ in self.waiting])
        width, outputs = len(self.codes.high), len(self.outputs)

        def opened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            coded = np.ascontiguousarray(_matrix(batch.column(0), "<u2", width).T)
            scores = _matrix(batch.column(2), "<f8", outputs).T.copy()
            if len(trees.roots):
                trees.add_to(scores, coded)
            return coded, batch.column(1).to_numpy(), scores

        return opened

    def write(self) -> None:
        """Writes the scores so far, so that a lost executor's rows are read again and passes stay short."""
        opened = self._opened()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, _, scores = opened(batch)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _binary(np.ascontiguousarray(scores.T))], ["codes", "goal", "scores"])

        older, self.written = self.written, cut_lineage(self.frame.mapInArrow(run, "codes binary, goal double, scores binary"))
        self.frame.unpersist()
        self.frame = self.written.rows.persist(StorageLevel.MEMORY_AND_DISK)
        self.waiting = []
        if older is not None:
            older.drop()

    def release(self) -> None:
        self.frame.unpersist()
        if self.written is not None:
            self.written.drop()

    def _gradients(self):
        """A function from goal and scores to (gradient, second derivative) per output."""
        runs = list(self.runs.values())

        def gradients(goal: np.ndarray, scores: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
            g, h, at = [], [], 0
            for p in runs:
                own = scores[at : at + p.outputs]
                at += p.outputs
                if p.task == "amount":
                    g.append(own[0] - goal), h.append(np.ones(len(goal)))
                    continue
                likely = np.exp(own - own.max(axis=0))
                likely /= likely.sum(axis=0)
                for k in range(p.outputs):
                    g.append(likely[k] - (goal == k)), h.append(np.maximum(likely[k] * (1 - likely[k]), HESSIAN_FLOOR))
            return g, h

        return gradients

    def sums(self, members: Sequence[int], kind: str):
        """``sums`` of a grower whose tree ``t`` belongs to output ``members[t]``."""
        offsets = self.codes.offsets
        slots = int(offsets[-1])
        width = 2 if kind == "mse" else 3

        def summed(plans, trees: Sequence[Tree], asked: dict[int, list[int]]) -> dict[tuple[int, int], np.ndarray]:
            opened, gradients = self._opened(), self._gradients()
            wanted = [(t, i) for t, ids in sorted(asked.items()) for i in ids]
            place = {key: at for at, key in enumerate(wanted)}
            # A tree whose leaf values are the places of the nodes asked for; rows below a node asked for stay in it.
            flat = []
            for t, ids in sorted(asked.items()):
                nodes = flat_tree(trees[t])
                codes = self.codes.of_tree(trees[t], 1.0)
                marked = {}
                stack = [(1, -1)]
                while stack:
                    i, inside = stack.pop()
                    inside = place.get((t, i), inside)
                    node = codes[i]
                    marked[i] = (None, None, 0, 0, float(inside)) if nodes[i][0] is None or inside >= 0 else node
                    if marked[i][0] is not None:
                        stack += [(node[2], inside), (node[3], inside)]
                low, high = place[t, ids[0]] * slots, (place[t, ids[-1]] + 1) * slots  # a tree's nodes are neighbours
                flat.append((members[t], FlatTrees.of([marked], [0]), low, high))
            total = len(wanted) * slots

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                held = np.zeros((width, total))
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    coded, goal, scores = opened(batch)
                    g, h = gradients(goal, scores)
                    own = offsets[:-1, None] + coded
                    for output, tree, low, high in flat:
                        node = tree.value[tree.leaves(coded)[0]].astype(np.int64)
                        rows = np.flatnonzero(node >= 0)
                        slot = (own[:, rows] + (node[rows] * slots - low)).ravel()
                        held[0, low:high] += np.bincount(slot, minlength=high - low)
                        sign = -g[output][rows] if kind == "mse" else g[output][rows]
                        held[1, low:high] += np.bincount(slot, np.tile(sign, len(own)), minlength=high - low)
                        if width == 3:
                            held[2, low:high] += np.bincount(slot, np.tile(h[output][rows], len(own)), minlength=high - low)
                at = np.flatnonzero(held[0])
                yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(held[i, at]) for i in range(width)]], names)

            names = ["slot", *[f"s{i}" for i in range(width)]]
            cells = self.frame.mapInArrow(run, ", ".join(["slot long", *[f"s{i} double" for i in range(width)]]))
            table = cells.groupBy("slot").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).toArrow()
            dense = np.zeros((width, total))
            at = table.column(0).to_numpy()
            for i in range(width):
                dense[i, at] = table.column(i + 1).to_numpy()
            return {key: dense[:, n * slots : (n + 1) * slots].copy() for key, n in place.items()}

        return summed

    def metrics(self) -> dict[str, float]:
        """Train error or accuracy of every run at its present scores."""
        opened, runs = self._opened(), list(self.runs.items())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = np.zeros(len(runs)), 0
            for batch in batches:
                _, goal, scores = opened(batch)
                rows, at = rows + len(goal), 0
                for i, (_, p) in enumerate(runs):
                    own = scores[at : at + p.outputs]
                    at += p.outputs
                    if p.task == "amount":
                        held[i] += ((goal - own[0]) ** 2).sum()
                    else:
                        likely = np.exp(own - own.max(axis=0))
                        held[i] += (np.round(likely / likely.sum(axis=0), 9).argmax(axis=0) == goal).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(runs))), pa.array(held), pa.array([rows] * len(runs), pa.int64())], ["run", "v", "n"])

        found = self.frame.mapInArrow(run, "run long, v double, n long").groupBy("run").agg(F.sum("v"), F.sum("n")).collect()
        return {runs[r[0]][0]: r[1] / r[2] for r in found if r[2]}


def fit_binned(
    train: DataFrame,
    features: Sequence[str],
    runs: dict[str, BoostParams],
    label: str = "cls",
    target: str = "y",
    curve_every: int = 0,
    max_bins: int = 255,
    codes: Codes | None = None,
) -> tuple[dict[str, BoostedModel], list[tuple[str, int, str, float]]]:
    """Like ``fit_boosted``, for runs without row sampling, from histograms of at most ``max_bins`` bins per feature.

    Runs and classes share every pass; a round has as many passes as its trees have levels, and one more every
    ``WRITE_EVERY`` rounds. Rows without a label or target take no part. ``codes`` are the bins of an earlier fit on the
    same rows; without them they are planned.
    """
    _check(runs)
    if any(p.goss is not None for p in runs.values()):
        raise ValueError("runs that sample rows are fitted by fit_boosted")
    features = tuple(features)
    first = next(iter(runs.values()))
    goal = label if first.task == "class" else target
    rows = train.filter(F.col(goal).isNotNull())
    mean, count = rows.agg(F.avg(F.col(goal).cast("double")), F.count(F.lit(1))).first()
    if mean is None:
        raise ValueError("there are no train rows")
    rows = few_tasks(rows, count)
    start = {run: math.log(1.0 / p.n_classes) if p.task == "class" else float(mean) for run, p in runs.items()}
    codes = codes or plan_codes(rows, features, max_bins)
    models = {run: BoostedModel(run, p, features, start[run]) for run, p in runs.items()}
    coded = _Rows(_coded(rows, features, goal, codes, [start[run] for run, p in runs.items() for _ in range(p.outputs)]), codes, runs)
    curve: list[tuple[str, int, str, float]] = []
    last = max(p.rounds for p in runs.values())
    try:
        for number_of_round in range(1, last + 1):
            members = [o for o, (run, _) in enumerate(coded.outputs) if number_of_round <= runs[run].rounds]
            plans = [_limits(runs[coded.outputs[o][0]]) for o in members]
            grower = BinnedGrower(coded.sums(members, first.kind), codes, features, first.kind, first.cut)
            if first.growth == "depth":
                trees = grower.by_depth(plans)
            elif first.growth == "leaf":
                trees = grower.by_leaf(plans)
            else:
                trees = grower.by_level(plans, first.level_gain)
            for o, tree in zip(members, trees):
                run, k = coded.outputs[o]
                if k == 0:
                    models[run].trees.append([])
                models[run].trees[-1].append(tree)
                coded.waiting.append((o, codes.of_tree(tree, runs[run].learning_rate)))
            if number_of_round % WRITE_EVERY == 0 and number_of_round < last:
                coded.write()
            if curve_every and number_of_round % curve_every == 0:
                metric = "mse" if first.task == "amount" else "accuracy"
                found = coded.metrics()
                curve += [(run, number_of_round, metric, found[run]) for run, p in runs.items() if number_of_round <= p.rounds]
    finally:
        coded.release()
    return models, curve


def _limits(params: BoostParams) -> Plan:
    return Plan({}, max_depth=params.max_depth, num_leaves=params.num_leaves, min_rows=params.min_rows, lam=params.lam, gamma=params.gamma)
