"""Long fits of oblivious trees on train rows that are kept in the order of every feature.

A level's cuts need running sums in the order of each feature, and that order is the same in all rounds. So the rows are
sorted once per feature and kept as pieces of neighbouring rows, each with all it takes to know a row's node and gradients.
A level is then two passes without a shuffle: the sums of every piece, and, with the sums of the pieces before it, the best
of its cuts. What returns to the driver is a few numbers per piece, tree and node. All values are searched, as by ``Grower``.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.losses import HESSIAN_FLOOR
from daybook.functions.text import name
from daybook.operators.grower import leaf_of
from daybook.operators.trees import Tree
from daybook.session import TASK_ROWS, cut_lineage

#: Rounds after which the scores so far are written to the shared folder.
WRITE_EVERY = 10
#: Numbers of a piece, its rows times the features.
PIECE_CELLS = 1 << 20
#: Pieces of a task, which takes longer to start than to read a few of them.
TASK_PIECES = 2
#: Up to this many rows a pass is shorter than starting it, and one task goes through all rounds.
ALONE_ROWS = 2 * TASK_ROWS

_PIECE = "feature int, piece int, inputs binary, goal binary, scores binary"


@dataclass(frozen=True)
class LevelTree:
    """(feature, threshold) per level, and the values of the leaves; what is not at most the threshold goes right."""

    cuts: tuple[tuple[int, float], ...] = ()
    values: np.ndarray | None = None

    @property
    def nodes(self) -> int:
        return 1 << len(self.cuts)

    def place(self, inputs: np.ndarray) -> np.ndarray:
        at = np.zeros(inputs.shape[1], np.uint16)
        for f, point in self.cuts:
            at = (at << 1) | ~(inputs[f] <= point)
        return at


@dataclass
class Piece:
    """Neighbouring rows in the order of ``feature``, nulls first; nulls are NaN here."""

    feature: int
    number: int
    inputs: np.ndarray
    goal: np.ndarray
    scores: np.ndarray
    graded: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # gradients by score, while scores stay

    def add(self, trees: Sequence[tuple[int, LevelTree]]) -> None:
        for at, tree in trees:
            self.scores[at] += tree.values[tree.place(self.inputs)]
        self.graded.clear()


@dataclass(frozen=True)
class Edge:
    """What a piece's neighbours hold: whether its first value began before it, whether its last one ends in it, and the
    next value."""

    begun: bool = False
    ended: bool = True
    after: float | None = None


@dataclass(frozen=True)
class Output:
    """A score of a run: its place among all scores, its class of how many (None for an amount), and the limits of its trees."""

    run: str
    at: int
    first: int
    cls: int | None
    n_classes: int
    rounds: int
    rate: float
    max_depth: int
    min_rows: int
    lam: float
    gamma: float

    def gradients(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        if self.at not in piece.graded:
            unknown = np.isnan(piece.goal)
            if self.cls is None:
                piece.graded[self.at] = np.where(unknown, 0.0, piece.scores[self.at] - piece.goal), np.ones(len(piece.goal))
            else:
                own = piece.scores[self.first : self.first + self.n_classes]
                weights = np.exp(own - own.max(axis=0))
                for k, p in enumerate(weights / weights.sum(axis=0)):
                    g = np.where(unknown, 0.0, p - (piece.goal == k))
                    piece.graded[self.first + k] = g, np.maximum(p * (1 - p), HESSIAN_FLOOR)
        return piece.graded[self.at]


def suits(runs) -> bool:
    """For fits of more than a few rounds, where sorting once pays."""
    return all(
        p.growth == "oblivious" and p.level_gain == "owner" and p.kind == "newton" and p.goss is None and p.max_depth <= 16
        for p in runs.values()
    )


def outputs_of(runs) -> list[Output]:
    found: list[Output] = []
    for run, p in runs.items():
        first = len(found)
        for k in range(p.outputs):
            found.append(
                Output(run, first + k, first, k if p.task == "class" else None, p.outputs, p.rounds, p.learning_rate,
                       p.max_depth, p.min_rows, p.lam, p.gamma)
            )
    return found


def node_sums(piece: Piece, asked: Sequence[tuple[Output, LevelTree]]) -> list[np.ndarray]:
    """(nodes, 3) per tree: rows, gradients and second derivatives."""
    found = []
    for output, tree in asked:
        place = tree.place(piece.inputs)
        found.append(np.stack([np.bincount(place, s, tree.nodes) for s in (None, *output.gradients(piece))], axis=1).astype(float))
    return found


def best_cuts(
    piece: Piece, asked: Sequence[tuple[Output, LevelTree]], edge: Edge = Edge(), before: list[np.ndarray] | None = None,
    total: list[np.ndarray] | None = None,
) -> list[tuple[float, float, float] | None]:
    """(gain, value, next value) per tree: the best cut of any node at a value that ends in this piece.

    ``before`` are the sums of the pieces before it, ``total`` those of all pieces; without them it is the only one.
    """
    x = piece.inputs[piece.feature]
    known = x[~np.isnan(x)]
    after = None if edge.after is None or np.isnan(edge.after) or np.isnan(x[-1]) else edge.after
    top = np.inf if after is not None else known[-1] if len(known) else -np.inf
    found = []
    for t, (output, tree) in enumerate(asked):
        place = tree.place(piece.inputs)
        order = np.argsort(place, kind="stable")
        ends = np.cumsum(np.bincount(place, minlength=tree.nodes))
        stats = output.gradients(piece)
        best = None
        for k in range(tree.nodes):
            at = order[ends[k - 1] if k else 0 : ends[k]]
            base = np.zeros(3) if before is None else before[t][k]
            sums = np.stack([base[0] + np.arange(len(at) + 1), *[np.cumsum(np.r_[b, s[at]]) for b, s in zip(base[1:], stats)]])
            whole = sums[:, -1] if total is None else total[t][k]
            own = x[at]
            last = np.flatnonzero(np.r_[own[1:] != own[:-1], len(at) > 0][: len(at)])
            if len(at) and not edge.ended and own[-1] == x[-1]:
                last = last[:-1]
            value, left = own[last], sums[:, last + 1]
            if edge.begun and not (len(at) and own[0] == x[0]) and (edge.ended or x[0] != x[-1]):
                # Rows of the node may have this value in the pieces before; if none has, a lower cut is as good.
                value, left = np.r_[x[0], value], np.c_[base, left]
            cut = _best(value, left, whole, output, top)
            if cut is not None and (best is None or cut[0] > best[0] or cut[0] == best[0] and cut[1] < best[1]):
                best = cut
        if best is not None:
            place_of_next = np.searchsorted(known, best[1], "right")
            best = (*best, float(known[place_of_next]) if place_of_next < len(known) else after)
        found.append(best)
    return found


def _best(value: np.ndarray, left: np.ndarray, whole: np.ndarray, output: Output, top: float) -> tuple[float, float] | None:
    """(gain, value) of a node's best cut, the lowest of equal ones; gains are settled as by ``splits``."""
    right = whole[:, None] - left
    with np.errstate(invalid="ignore"):
        allowed = (value < top) & (left[0] >= output.min_rows) & (right[0] >= output.min_rows)
    if not allowed.any():
        return None
    value, left, right = value[allowed], left[:, allowed], right[:, allowed]

    def share(s):
        weight = s[2] + output.lam
        return np.divide(s[1] * s[1], weight, out=np.zeros_like(weight), where=weight != 0)

    a, b = share(left), share(right)
    gain = 0.5 * (a + b - share(whole[:, None])) - output.gamma
    gain = np.where(gain > 1e-12 * (0.5 * (a + b)), gain.astype(np.float32).astype(float), 0.0)
    at = int(gain.argmax())
    return (float(gain[at]), float(value[at])) if gain[at] > 0 else None


class Alone:
    """All pieces in one task, one per feature."""

    def __init__(self, pieces: Sequence[Piece]):
        self.pieces = pieces

    def sums(self, asked):
        return node_sums(self.pieces[0], asked)

    def cuts(self, asked):
        return [(p.feature, best_cuts(p, asked)) for p in self.pieces]

    def add(self, trees: list[tuple[int, LevelTree]]) -> None:
        for piece in self.pieces:
            piece.add(trees)


class Table:
    """A row per piece, and the trees that the written scores do not hold yet."""

    def __init__(self, packed: DataFrame, features: int):
        self.width = features
        self.waiting: list[tuple[int, LevelTree]] = []
        self.rounds = 0
        self.written = cut_lineage(packed)
        self.kept: DataFrame | None = None
        self.count = 0
        self._keep()
        ends = self._ask(lambda p: (p.inputs[p.feature][0], p.inputs[p.feature][-1]))
        order = list(ends)
        self.edges = {}
        for older, at, newer in zip([None, *order], order, [*order[1:], None]):
            before = ends[older][1] if older and older[0] == at[0] else None
            after = float(ends[newer][0]) if newer and newer[0] == at[0] else None
            self.edges[at] = Edge(before is not None and before == ends[at][0], after is None or after != ends[at][1], after)

    def _keep(self) -> None:
        """Few pieces per task; a reader would give it many, by the size of the files."""
        older = self.kept
        rows = self.written.rows
        self.count = self.count or rows.count()
        self.kept = rows.repartition(-(-self.count // TASK_PIECES)).persist(StorageLevel.MEMORY_AND_DISK)
        if older is not None:
            older.unpersist()

    def _opened(self):
        """A function from a batch to its pieces at the present scores."""
        waiting, width = list(self.waiting), self.width

        def opened(batch: pa.RecordBatch) -> Iterator[Piece]:
            for row in range(batch.num_rows):
                inputs, goal, scores = (np.frombuffer(batch.column(i)[row].as_buffer(), "<f8") for i in (2, 3, 4))
                feature, number = (batch.column(i)[row].as_py() for i in (0, 1))
                piece = Piece(feature, number, inputs.reshape(width, len(goal)), goal, scores.reshape(-1, len(goal)).copy())
                piece.add(waiting)
                yield piece

        return opened

    def _ask(self, question: Callable[[Piece], object], only: int | None = None) -> dict[tuple[int, int], object]:
        """The answers of all pieces, or of those of one feature."""
        opened = self._opened()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p in opened(batch):
                    answer = pickle.dumps(question(p))
                    yield pa.RecordBatch.from_arrays([pa.array([p.feature], pa.int32()), pa.array([p.number], pa.int32()), pa.array([answer])], ["feature", "piece", "answer"])

        rows = self.kept if only is None else self.kept.filter(F.col("feature") == only)
        found = rows.mapInArrow(run, "feature int, piece int, answer binary").collect()
        return {(r[0], r[1]): pickle.loads(r[2]) for r in sorted(found)}

    def sums(self, asked):
        answers = self._ask(lambda p: node_sums(p, asked), only=0)
        return [sum(trees) for trees in zip(*answers.values())]

    def cuts(self, asked):
        edges = self.edges
        if len(edges) == self.width:  # a piece per feature
            before, total = {}, {}
        else:
            before, total = self._before(self._ask(lambda p: node_sums(p, asked)))
        answers = self._ask(lambda p: best_cuts(p, asked, edges[p.feature, p.number], before.get((p.feature, p.number)), total.get(p.feature)))
        return [(f, cuts) for (f, _), cuts in answers.items()]

    @staticmethod
    def _before(sums: dict[tuple[int, int], list[np.ndarray]]):
        """Per piece the sums of the feature's pieces before it, and per feature those of all."""
        before, total = {}, {}
        for (f, n), own in sums.items():  # in order
            held = total.get(f) or [np.zeros_like(s) for s in own]
            before[f, n] = held
            total[f] = [a + b for a, b in zip(held, own)]
        return before, total

    def add(self, trees: list[tuple[int, LevelTree]]) -> None:
        self.waiting += trees
        self.rounds += 1
        if self.rounds % WRITE_EVERY:
            return
        opened = self._opened()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from (_packed(p) for p in opened(batch))

        older, self.written = self.written, cut_lineage(self.kept.mapInArrow(run, _PIECE))
        self.waiting = []
        self._keep()
        older.drop()

    def release(self) -> None:
        if self.kept is not None:
            self.kept.unpersist()
        self.written.drop()


def _packed(p: Piece) -> pa.RecordBatch:
    held = [pa.array([np.ascontiguousarray(a, "<f8").tobytes()], pa.binary()) for a in (p.inputs, p.goal, p.scores)]
    return pa.RecordBatch.from_arrays([pa.array([p.feature], pa.int32()), pa.array([p.number], pa.int32()), *held], ["feature", "piece", "inputs", "goal", "scores"])


def _matrix(batches: Sequence[pa.RecordBatch], columns: Sequence[str]) -> np.ndarray:
    table = pa.Table.from_batches(batches)
    return np.stack([pc.fill_null(table.column(c), np.nan).to_numpy() for c in columns])


def pieces_of(rows: DataFrame, width: int, starts: Sequence[float], count: int) -> DataFrame:
    """A row per piece: the rows ``c0.., goal, k0..`` in the order of each feature, then of the keys, so that a value of
    very many rows is shared by pieces."""
    pieces = -(-count * width // PIECE_CELLS)
    columns = [f"c{f}" for f in range(width)]
    keys = [c for c in rows.columns if c.startswith("k")]
    copies = None
    for f in range(width):
        order = [columns[f], *keys]
        ranged = rows.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
        copy = ranged.selectExpr(f"{f} AS feature", "spark_partition_id() AS piece", *columns, "goal")
        copies = copy if copies is None else copies.union(copy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            numbers = _matrix(held, [*columns, "goal"])
            scores = np.tile(np.array(starts)[:, None], (1, numbers.shape[1]))
            feature, number = (held[0].column(i)[0].as_py() for i in range(2))
            yield _packed(Piece(feature, number, numbers[:-1], numbers[-1], scores))

    return copies.mapInArrow(run, _PIECE)


def grow_rounds(rows, outputs: Sequence[Output]) -> list[list[tuple[int, Tree]]]:
    """The trees of all rounds with their outputs' places. ``rows`` answers for ``sums`` and ``cuts`` and takes trees by ``add``."""
    rounds = []
    for number in range(1, max(o.rounds for o in outputs) + 1):
        active = [o for o in outputs if number <= o.rounds]
        grown = {o.at: LevelTree() for o in active}
        gains: dict[int, list[float]] = {o.at: [] for o in active}
        growing = active
        for depth in range(max(o.max_depth for o in active)):
            growing = [o for o in growing if depth < o.max_depth]
            best: dict[int, tuple] = {}
            for feature, cuts in rows.cuts([(o, grown[o.at]) for o in growing]) if growing else []:
                for o, cut in zip(growing, cuts):
                    if cut is not None:
                        gain, value, after = cut
                        best[o.at] = max(best.get(o.at, (0.0,)), (gain, -feature, -value, after))
            growing = [o for o in growing if o.at in best]
            for o in growing:
                gain, feature, value, after = best[o.at]
                grown[o.at] = LevelTree((*grown[o.at].cuts, (-feature, (-value + after) / 2)))
                gains[o.at].append(gain)
        sums = rows.sums([(o, grown[o.at]) for o in active])
        trees = [(o.at, _tree(grown[o.at], gains[o.at], s, o.lam)) for o, s in zip(active, sums)]
        rounds.append(trees)
        if number < max(o.rounds for o in outputs):
            rows.add([(o.at, LevelTree(grown[o.at].cuts, o.rate * _values(grown[o.at], tree))) for o, (_, tree) in zip(active, trees)])
    return rounds


def _values(level: LevelTree, tree: Tree) -> np.ndarray:
    return np.array([tree.nodes[level.nodes + k].value for k in range(level.nodes)])


def _tree(level: LevelTree, gains: Sequence[float], sums: np.ndarray, lam: float) -> Tree:
    tree = Tree()
    for (feature, point), gain in zip(level.cuts, gains):
        for i in tree.leaves():
            tree.split(i, feature, point, gain, 2 * i, 2 * i + 1)
    for k, (n, g, h) in enumerate(sums.tolist()):
        if n:
            tree.nodes[level.nodes + k].stats = {"n": n, "g": g, "h": h}
    tree.settle(leaf_of("newton", lam))
    return tree


def fit_levels(
    frame: DataFrame, features: Sequence[str], keys: Sequence[str], goal: str, runs, start: dict[str, float], count: int
) -> dict[str, list[list[Tree]]]:
    """The trees of every run, ``[round][class]``; ``frame`` has ``count`` rows."""
    outputs = outputs_of(runs)
    starts = [start[o.run] for o in outputs]
    width = len(features)
    rows = frame.selectExpr(
        *[f"double({name(f)}) AS c{i}" for i, f in enumerate(features)], f"double({name(goal)}) AS goal",
        *[f"{name(k)} AS k{i}" for i, k in enumerate(keys)],
    )
    if count <= ALONE_ROWS:

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            numbers = _matrix(held, [*[f"c{i}" for i in range(width)], "goal"])
            pieces = []
            for f in range(width):
                # Rows come by their keys; nulls go first, NaN last.
                column = pa.chunked_array([b.column(f) for b in held])
                rank = np.where(column.is_null(nan_is_null=False).to_numpy(), -1, np.where(np.isnan(numbers[f]), 1, 0))
                order = np.lexsort((np.where(rank == 0, numbers[f], 0.0), rank))
                pieces.append(Piece(f, 0, numbers[:-1, order], numbers[-1, order], np.tile(np.array(starts)[:, None], (1, len(order)))))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(grow_rounds(Alone(pieces), outputs))])], ["trees"])

        ordered = rows.coalesce(1).sortWithinPartitions(*[c for c in rows.columns if c.startswith("k")])
        rounds = pickle.loads(ordered.mapInArrow(whole, "trees binary").first()[0])
    else:
        table = Table(pieces_of(rows, width, starts, count), width)
        try:
            rounds = grow_rounds(table, outputs)
        finally:
            table.release()
    found: dict[str, list[list[Tree]]] = {run: [] for run in runs}
    for trees in rounds:
        for at, tree in trees:
            if outputs[at].at == outputs[at].first:
                found[outputs[at].run].append([])
            found[outputs[at].run][-1].append(tree)
    return found
