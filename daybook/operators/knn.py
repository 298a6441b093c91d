"""K nearest neighbours, exact.

``knn_by_account`` answers from the account's own days, which the calendar bounds.

``knn_pooled`` answers from all train rows. It never forms all pairs of rows:

1. equal vectors are merged first, so copies cost one row (at most ``k`` of them can ever be neighbours);
2. vectors are put into cells around a bounded number of pivots; the triangle inequality gives each query an
   upper bound for its k-th distance and each cell a lower bound, and only cells that can matter are visited
   (Lu, Shen, Chen, Ooi: Efficient processing of k nearest neighbor joins using MapReduce, VLDB 2012);
3. cells are packed into blocks of train vectors, large ones cut, and a query is sent once to each block that holds one
   of its cells; a task holds one bounded block of each side and returns at most ``k`` rows per query;
4. a block's distances are first taken with bounded error, by matrix products or in 32 bits, over pieces that fit the
   caches; the exact ones follow for the few vectors that can be among the ``k``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from daybook.functions.text import name
from daybook.session import cut_lineage

DIGITS = 9
_SLACK = 1e-7
# Numbers that one step of a task holds at once.
STEP_NUMBERS = 4_000_000
# Numbers of a step that is to stay in the caches.
_NEAR_NUMBERS = 1 << 17
# Train vectors and queries of a task, at 64 numbers a vector; wider vectors have smaller blocks.
TRAIN_BLOCK = 16_384
QUERY_BLOCK = 8_192
_BLOCK_WIDTH = 64
_MOST_TASKS = 2_000
# Smaller numbers are subtracted in 32 bits at first.
_NARROW = 1e18
# More than half of the last digit that is kept.
_ROUNDING = 10.0 ** (1 - DIGITS)


def vote(neighbours: str, classes: str) -> str:
    """Expression text: most frequent label of an array of structs, the lowest label on ties."""
    return (
        f"array_max(transform({classes}, c -> named_struct("
        f"'votes', size(filter({neighbours}, x -> x.label = c)), 'low', -c))).low * -1"
    )


def knn_by_account(
    rows: DataFrame, features: Sequence[str], k: int = 3, metric: str = "manhattan", label: str = "cls"
) -> DataFrame:
    """Adds ``pred`` to the test rows: vote of the account's ``k`` nearest train days.

    Neighbours are ordered by (distance, label, day). The days of an account, bounded by the calendar, are
    gathered in one row; a test day meets the train days as an array, and pairs are never rows.
    """
    inputs = ", ".join(f"double({name(f)})" for f in features)
    own = ", ".join(f"'{c}', {name(c)}" for c in rows.columns)
    accounts = rows.withColumn("__x", F.expr(f"array({inputs})")).groupBy("account_id").agg(
        F.expr(
            f"collect_list(IF(part = 'train', named_struct('x', __x, 'label', {name(label)}, 'day', day), NULL))"
        ).alias("__train"),
        F.expr(f"collect_list(IF(part = 'test', named_struct('x', __x, 'own', named_struct({own})), NULL))").alias("__test"),
    )
    parts = [f"__q.x[{i}] - t.x[{i}]" for i in range(len(features))]
    if metric == "manhattan":
        distance = " + ".join(f"abs({p})" for p in parts)
    elif metric == "euclidean":
        distance = "sqrt(" + " + ".join(f"({p}) * ({p})" for p in parts) + ")"
    else:
        raise ValueError("metric is 'manhattan' or 'euclidean'")
    ranked = (
        f"slice(array_sort(transform(__train, t -> named_struct('d', round({distance}, {DIGITS}), "
        f"'label', t.label, 'day', t.day))), 1, {k})"
    )
    return (
        accounts.selectExpr("__train", "explode(__test) AS __q")
        .selectExpr("__q.own AS __own", f"{ranked} AS __near")
        .selectExpr("__own.*", f"{vote('__near', 'array_distinct(transform(__near, x -> x.label))')} AS pred")
    )


@dataclass(frozen=True)
class _Cells:
    """Pivots and, per cell, its size, range and nearest distances. Bounded by the number of pivots."""

    pivots: np.ndarray
    sizes: list[int]
    low: np.ndarray
    high: np.ndarray
    nearest: np.ndarray


def _distance_code():
    def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
        """Distances of all rows of ``a`` to all rows of ``b``, in slices that keep memory small."""
        out = np.empty((len(a), len(b)))
        step = max(1, _NEAR_NUMBERS // max(1, b.size))
        for start in range(0, len(a), step):
            diff = a[start : start + step, None, :] - b[None, :, :]
            if metric == "manhattan":
                out[start : start + step] = np.abs(diff).sum(axis=2)
            else:
                out[start : start + step] = np.sqrt((diff * diff).sum(axis=2))
        return out

    return distances


def _steps(rows: int, width: int):
    """Slices of ``rows`` rows that hold about ``STEP_NUMBERS`` numbers at ``width`` numbers a row."""
    step = max(1, STEP_NUMBERS // max(1, width))
    return [slice(start, start + step) for start in range(0, rows, step)]


def _cell_udf(pivots: np.ndarray, metric: str):
    distances = _distance_code()

    @F.pandas_udf("cell int, dist double")
    def nearest_pivot(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack(vectors.to_numpy())
        cell, dist = np.empty(len(x), np.int32), np.empty(len(x))
        for part in _steps(len(x), len(pivots)):
            d = distances(x[part], pivots, metric)
            cell[part] = d.argmin(axis=1)
            dist[part] = d.min(axis=1)
        return pd.DataFrame({"cell": cell, "dist": dist})

    return nearest_pivot


def _bounds(d: np.ndarray, cells: _Cells, k: int) -> np.ndarray:
    """Upper bounds for the k-th distances of queries at distances ``d`` from all pivots."""
    bound = np.empty(len(d))
    for part in _steps(len(d), cells.nearest.size):
        upper = (d[part][:, :, None] + cells.nearest[None, :, :]).reshape(len(d[part]), -1)
        bound[part] = np.partition(upper, k - 1, axis=1)[:, k - 1]
    return bound * (1 + _SLACK) + _SLACK


def _reached(d: np.ndarray, near: np.ndarray, bound: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which cells can hold one of the k nearest: ``d`` to their pivots, ``near`` to the nearest of all pivots."""
    best = np.maximum(d - high[None, :], low[None, :] - d)
    return np.maximum(best, (d - near[:, None]) / 2) <= bound[:, None]


def _visit_udf(cells: _Cells, blocks: list[tuple[int, int]], metric: str, k: int):
    distances = _distance_code()

    @F.pandas_udf("near double, bound double, blocks array<int>")
    def blocks_to_visit(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack(vectors.to_numpy())
        near, bound, visits = np.empty(len(x)), np.empty(len(x)), []
        for part in _steps(len(x), max(1, cells.nearest.size)):
            d = distances(x[part], cells.pivots, metric)
            near[part], bound[part] = d.min(axis=1), _bounds(d, cells, k)
            for reached in _reached(d, near[part], bound[part], cells.low, cells.high):
                at = {b for j in np.flatnonzero(reached).tolist() for b in range(blocks[j][0], blocks[j][0] + blocks[j][1])}
                visits.append(np.array(sorted(at), np.int32))
        return pd.DataFrame({"near": near, "bound": bound, "blocks": visits})

    return blocks_to_visit


def _blocks(sizes: Sequence[int], most: int) -> list[tuple[int, int]]:
    """Per cell its first block and how many it has: large cells have their own, the others share blocks of ``most`` rows."""
    placed, following, shared, free = [], 0, 0, 0
    for size in sizes:
        if size > most:
            placed.append((following, -(-size // most)))
            following += placed[-1][1]
            continue
        if size > free:
            shared, free, following = following, most, following + 1
        placed.append((shared, 1))
        free -= size
    return placed


def _vectors(rows: DataFrame, vector: str) -> DataFrame:
    return rows.withColumn("__x", F.col(vector).cast("array<double>"))


def _merge_copies(train: DataFrame, row_id: str, label: str, k: int) -> DataFrame:
    """One row per distinct vector with its first ``k`` members by (label, id).

    The rank filter works inside every map task before the shuffle, so a vector with very many copies sends
    at most ``k`` rows per task.
    """
    return (
        train.select("__x", F.col(label).cast("int").alias("label"), F.col(row_id).cast("long").alias("id"))
        .withColumn("rn", F.row_number().over(Window.partitionBy("__x").orderBy("label", "id")))
        .filter(F.col("rn") <= k)
        .groupBy("__x")
        .agg(F.sort_array(F.collect_list(F.struct("label", "id"))).alias("members"))
    )


def _plan_cells(distinct: DataFrame, metric: str, k: int) -> tuple[DataFrame, _Cells]:
    distinct = distinct.persist(StorageLevel.MEMORY_AND_DISK)
    count = distinct.count()
    # The driver holds the pivots: the square root of the number of vectors.
    wanted = max(1, math.isqrt(count))
    picked = distinct.select("__x").orderBy(F.xxhash64("__x"), "__x").limit(wanted).collect()
    pivots = np.array([r["__x"] for r in picked])
    placed = distinct.withColumn("__c", _cell_udf(pivots, metric)("__x")).select("__x", "members", "__c.*")
    placed = cut_lineage(placed).rows
    distinct.unpersist()
    near = Window.partitionBy("cell").orderBy("dist")
    nearest = (
        placed.select("cell", "dist")
        .withColumn("rn", F.row_number().over(near))
        .filter(F.col("rn") <= k)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("dist")).alias("nearest"))
    )
    stats = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("size"), F.min("dist").alias("low"), F.max("dist").alias("high")
    )
    sizes, low, high = [0] * len(pivots), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
    closest = np.full((len(pivots), k), np.inf)
    for r in stats.join(nearest, "cell").collect():
        sizes[r["cell"]], low[r["cell"]], high[r["cell"]] = r["size"], r["low"], r["high"]
        closest[r["cell"], : len(r["nearest"])] = r["nearest"]
    return placed, _Cells(pivots, sizes, low, high, closest)


def knn_pooled(
    train: DataFrame, test: DataFrame, vector: str, row_id: str, label: str = "label", k: int = 3,
    metric: str = "manhattan", train_block: int = TRAIN_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Adds ``pred`` to the test rows: vote of the ``k`` nearest train rows by (distance, label, id)."""
    if metric not in ("manhattan", "euclidean"):
        raise ValueError("metric is 'manhattan' or 'euclidean'")
    distinct = _merge_copies(_vectors(train, vector), row_id, label, k)
    placed, cells = _plan_cells(distinct, metric, k)
    wide = max(1, cells.pivots.shape[-1] // _BLOCK_WIDTH)
    blocks = _blocks(cells.sizes, max(1, train_block // wide))
    asked = _vectors(test, vector).select("__x").distinct().withColumn("v", _visit_udf(cells, blocks, metric, k)("__x"))
    # Numbered once, as written: what the blocks find then carries a number for its query.
    queries = cut_lineage(asked.selectExpr("monotonically_increasing_id() AS query", "__x", "v.*")).rows
    visits = queries.selectExpr("query", "__x AS q", "near", "bound", "explode(blocks) AS block")
    most = visits.groupBy("block").count().agg(F.max("count")).first()[0] or 0
    turns = max(1, math.ceil(most / max(1, query_block // wide)))
    first, pieces = (f"array({', '.join(str(b[i]) for b in blocks) or '0'})[cell]" for i in (0, 1))
    left = visits.selectExpr("block", f"int(pmod(xxhash64(query), {turns})) AS turn", "query", "q", "near", "bound")
    right = placed.selectExpr(
        f"int({first} + pmod(xxhash64(__x), {pieces})) AS block",
        f"explode(sequence(0, {turns} - 1)) AS turn",
        "cell",
        "__x AS x",
        "transform(members, m -> double(m.label)) AS labels",
        f"transform(members, m -> coalesce(m.id, {-(2**63) + 1}L)) AS ids",
    )
    keys = ["block", "turn"]
    tasks = max(1, min(_MOST_TASKS, turns * (max((a + n for a, n in blocks), default=1))))
    spread = [side.repartition(tasks, *keys).groupBy(*keys) for side in (left, right)]
    schema = T.StructType(
        [
            T.StructField("query", T.LongType()),
            T.StructField("d", T.DoubleType()),
            T.StructField("label", T.IntegerType()),
            T.StructField("id", T.LongType()),
        ]
    )
    found = spread[0].cogroup(spread[1]).applyInPandas(_block_search(cells, metric, k), schema)
    order = Window.partitionBy("query").orderBy("d", "label", "id")
    nearest = (
        found.withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") <= k)
        .groupBy("query")
        .agg(F.collect_list(F.struct("label")).alias("near"))
        .selectExpr("query", f"{vote('near', 'array_distinct(transform(near, x -> x.label))')} AS pred")
    )
    answers = queries.select("query", "__x").join(nearest, "query").drop("query")
    return _vectors(test, vector).join(answers, "__x").drop("__x")


def _rough_code(x: np.ndarray, metric: str):
    """A function that gives the distances of queries to slices of ``x``, and their largest error. Euclidean ones are squared."""
    dim = x.shape[1]
    large = float(np.nanmax(np.abs(x), initial=0.0))
    if metric == "euclidean":
        norms = (x * x).sum(axis=1)

        def squares(q: np.ndarray, at: slice) -> tuple[np.ndarray, np.ndarray]:
            own = (q * q).sum(axis=1)
            rough = own[:, None] + norms[at][None, :] - 2 * (q @ x[at].T)
            return rough, (dim + 8) * 2.0**-50 * (own + norms[at].max())

        return squares
    by_number = np.ascontiguousarray(x.T)
    narrow = by_number.astype(np.float32) if large < _NARROW else by_number

    def sums(q: np.ndarray, at: slice) -> tuple[np.ndarray, np.ndarray]:
        reach = np.abs(q).max(axis=1)
        kind = np.float32 if narrow.dtype == np.float32 and reach.max() < _NARROW else np.float64
        part = np.ascontiguousarray((narrow if kind == np.float32 else by_number)[:, at])
        rows, ones, gap = q.astype(kind), np.ones(dim, kind), np.empty_like(part)
        rough = np.empty((len(q), part.shape[1]), kind)
        for i, row in enumerate(rows):
            np.subtract(part, row[:, None], out=gap)
            np.abs(gap, out=gap)
            np.dot(ones, gap, out=rough[i])
        return rough.astype(np.float64), (dim + 8) * 2.0**-23 * dim * (reach + large)

    return sums


def _block_search(cells: _Cells, metric: str, k: int):
    distances = _distance_code()
    digits, kind = DIGITS, metric

    def exact(q: np.ndarray, x: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        for part in _steps(len(rows), x.shape[1]):
            gap = q[rows[part]] - x[columns[part]]
            out[part] = np.abs(gap).sum(axis=1) if kind == "manhattan" else np.sqrt((gap * gap).sum(axis=1))
        return np.round(out, digits)

    def search(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query": [], "d": [], "label": [], "id": []})
        vectors = vectors.sort_values("cell", kind="stable")
        x, q = np.stack(vectors["x"].to_numpy()), np.stack(queries["q"].to_numpy())
        labels, ids = vectors["labels"].to_numpy(), vectors["ids"].to_numpy()
        # Of vectors at one distance the k of smallest first members hold the k first rows.
        lead = np.nan_to_num(np.array([v[0] for v in labels]), nan=-np.inf)
        rank = np.empty(len(x), np.int64)
        rank[np.lexsort((np.array([v[0] for v in ids]), lead))] = np.arange(len(x))
        here, cell = np.unique(vectors["cell"].to_numpy(), return_inverse=True)
        near, bound = queries["near"].to_numpy(), queries["bound"].to_numpy()
        reached = np.empty((len(q), len(here)), bool)
        for part in _steps(len(q), len(here)):
            d = distances(q[part], cells.pivots[here], kind)
            reached[part] = _reached(d, near[part], bound[part], cells.low[here], cells.high[here])
        best, place = np.full((len(q), k), np.inf), np.full((len(q), k), -1, np.int64)
        rough_to = _rough_code(x, kind)
        width = max(1, _NEAR_NUMBERS // x.shape[1])
        for start in range(0, len(x), width):
            at = slice(start, min(start + width, len(x)))
            wanted = np.flatnonzero(reached[:, cell[at.start] : cell[at.stop - 1] + 1].any(axis=1))
            for part in _steps(len(wanted), 4 * width):
                some = wanted[part]
                rows, columns = _nearby(*rough_to(q[some], at), np.minimum(bound[some], best[some, k - 1]), kind, k)
                rows, columns = some[rows], columns + at.start
                d = exact(q, x, rows, columns)
                good = d <= best[rows, k - 1]
                _keep(best, place, rank, rows[good], columns[good], d[good], k)
        out = {"query": [], "d": [], "label": [], "id": []}
        for number, dist, at in zip(queries["query"].tolist(), best, place):
            found = [(d, c, i) for d, j in zip(dist.tolist(), at.tolist()) if j >= 0 for c, i in zip(labels[j].tolist(), ids[j].tolist())]
            for d, c, i in sorted(found, key=lambda f: (f[0], -math.inf if math.isnan(f[1]) else f[1], f[2]))[:k]:
                out["query"].append(number)
                out["d"].append(d)
                out["label"].append(None if math.isnan(c) else int(c))
                out["id"].append(i)
        out["label"] = pd.array(out["label"], dtype="Int32")
        return pd.DataFrame(out)

    return search


def _nearby(rough: np.ndarray, error: np.ndarray, limit: np.ndarray, metric: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the distances that can be up to ``limit`` and among the row's ``k`` smallest."""
    squared = metric == "euclidean"

    def reach(upto: np.ndarray) -> np.ndarray:
        return ((upto + _ROUNDING) ** 2 if squared else upto + _ROUNDING) + error

    most = reach(limit)
    # What can't be compared stays, and is taken exactly.
    close = ~(rough > most[:, None])
    if rough.shape[1] > k and np.count_nonzero(close) > 4 * k * len(rough):
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1] + error
        close &= ~(rough > reach(np.sqrt(np.maximum(kth, 0)) if squared else kth)[:, None])
    return np.nonzero(close)


def _keep(best: np.ndarray, place: np.ndarray, rank: np.ndarray, rows: np.ndarray, columns: np.ndarray, d: np.ndarray, k: int) -> None:
    """Merges found vectors into the ``k`` best of their rows, by distance and rank."""
    if not len(rows):
        return
    some, own = np.unique(rows, return_inverse=True)
    row = np.r_[np.repeat(np.arange(len(some)), k), own]
    dist, vector = np.r_[best[some].ravel(), d], np.r_[place[some].ravel(), columns]
    order = np.lexsort((np.where(vector < 0, len(rank), rank[vector]), dist, row))
    ordered = row[order]
    first = order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k]
    best[some], place[some] = dist[first].reshape(-1, k), vector[first].reshape(-1, k)
