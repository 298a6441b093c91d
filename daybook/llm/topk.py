"""Exact top-k inner products with block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import written

#: Vectors of one block of the document range.
BLOCK = 128
#: Blocks, and queries, of one group; a task works on a group of blocks and a group of queries at a time.
GROUP_BLOCKS = 64
GROUP_QUERIES = 512
_EXACT = float(1 << 53)
#: Below any score; its negative is a number, too.
_NONE = np.iinfo(np.int64).min + 1


def whole_vectors(rows: DataFrame, scale: float, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, v array<long>): every component as floor(scale * x); rows with a null id, null vector, or null or
    non-finite components are left out. Copies of a row stay."""
    x = F.col(vector_column)
    usable = F.col(id_column).isNotNull() & x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return rows.where(usable).select(
        F.col(id_column).cast("long").alias("id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("v")
    )


def _matrix(lists) -> np.ndarray:
    """Rows as one matrix; shorter vectors are filled up with zeros."""
    width = max(map(len, lists), default=0)
    out = np.zeros((len(lists), width), np.int64)
    for i, row in enumerate(lists):
        out[i, : len(row)] = row
    return out


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products; by floating point where no sum can leave the whole numbers it holds.

    Products that could leave 64 bits are refused.
    """
    top = float(np.abs(left.astype(np.float64)).max(initial=0)) * float(np.abs(right.astype(np.float64)).max(initial=0)) * left.shape[1]
    if top >= 2.0**62:
        raise ValueError("components are too large: a score could leave 64-bit whole numbers")
    if top < _EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


class BlockIndex:
    """Blocks of vectors in the order of their ids: the forward index of each, and per component its extremes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.starts = np.arange(0, len(ids), BLOCK)
        self.high = np.maximum.reduceat(self.vectors, self.starts, axis=0)
        self.low = np.minimum.reduceat(self.vectors, self.starts, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No vector of a block scores more: each component at whichever extreme suits the query."""
        return _products(np.maximum(queries, 0), self.high) + _products(np.minimum(queries, 0), self.low)

    def search(self, names: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(query, id, score) of the ``k`` best per query, ties to the smaller id, and how many blocks were scored.

        Each query takes its blocks in order of falling bounds and stops once a bound is below its k-th best score.
        ``floor`` holds what the k-th best is known to reach. Queries at the same block are scored together.
        """
        bound = self.bounds(queries)
        order = np.argsort(-bound, axis=1, kind="stable")
        kth, visited = floor.copy(), 0
        best_score = np.full((len(names), k), _NONE)
        best_id = np.full((len(names), k), np.iinfo(np.int64).max)
        active = np.arange(len(names))
        for nth in range(len(self.starts)):
            block = order[active, nth]
            active = active[bound[active, block] >= kth[active]]
            if not len(active):
                break
            block = order[active, nth]
            for b in np.unique(block):
                mine = active[block == b]
                visited += len(mine)
                lo, hi = self.starts[b], min(self.starts[b] + BLOCK, len(self.ids))
                score = _products(queries[mine], self.vectors[lo:hi])
                own = names[mine][:, None] == self.ids[None, lo:hi]
                score = np.where(own, _NONE, score)
                scores = np.concatenate([best_score[mine], score], axis=1)
                ids = np.concatenate([best_id[mine], np.broadcast_to(self.ids[lo:hi], score.shape)], axis=1)
                # candidates that tie with the k-th are kept by the smaller id
                top = np.lexsort((ids, -scores), axis=1)[:, :k]
                best_score[mine] = np.take_along_axis(scores, top, axis=1)
                best_id[mine] = np.take_along_axis(ids, top, axis=1)
                kth[mine] = np.maximum(kth[mine], best_score[mine, k - 1])
        keep = best_score > _NONE
        row, _ = np.nonzero(keep)
        return names[row], best_id[keep], best_score[keep], visited


def _grouped(vectors: DataFrame, rows: int, group: str) -> tuple[DataFrame, int]:
    """``vectors`` with a group number by ranges of the id, of about ``rows`` rows, and how many groups there are."""
    n = max(1, -(-vectors.count() // rows))
    ranged = vectors.repartitionByRange(n, "id") if n > 1 else vectors.coalesce(1)
    return written(ranged.withColumn(group, F.spark_partition_id()), "topk"), max(n, 1)


def top_products(rows: DataFrame, is_query, k: int, scale: float = 64.0, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest integer inner products of every query with all other rows.

    Vectors are dealt out by ranges of their ids; a group of blocks and a group of queries meet in a task, so each group
    is sent once per group of the other side and none is held whole. A first round scores each query in the one group that its own id
    lies in and gives it a floor; then the other groups are searched above it. ``is_query`` is a condition on ``id``.
    Rows that share an id are the query's own and no candidates of it. Fewer rows than ``k``: all of them. Vectors whose
    scores could leave 64 bits raise an error.
    """
    vectors = whole_vectors(rows, scale, id_column, vector_column)
    docs, n_docs = _grouped(vectors, BLOCK * GROUP_BLOCKS, "d")
    asks = docs.where(is_query).dropDuplicates(["id", "v"])

    no_floor = F.lit(None).cast("long").alias("floor")
    ask, doc = F.lit(True).alias("ask"), F.lit(False).alias("ask")
    cells = asks.select("d", "id", "v", no_floor, ask).union(docs.select("d", "id", "v", no_floor, doc))
    first = written(cells.groupBy("d").applyInPandas(_cell(k), _FOUND), "topk")
    floors = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    floored = asks.join(floors.select(F.col("query").alias("id"), "floor"), "id", "left")
    numbered, n_asks = _grouped(floored.withColumnRenamed("d", "home"), GROUP_QUERIES, "q")

    left = numbered.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_docs - 1))).alias("d")).where("d <> home")
    right = docs.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_asks - 1))).alias("q"))
    cells = left.select("q", "d", "id", "v", "floor", ask).union(right.select("q", "d", "id", "v", no_floor, doc))
    found = first.union(cells.groupBy("q", "d").applyInPandas(_cell(k), _FOUND))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")
    )


_FOUND = "query long, id long, score long"


def _cell(k: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        asks, docs = rows[rows["ask"]], rows[~rows["ask"]]
        if not len(asks) or not len(docs):
            return pd.DataFrame({"query": [], "id": [], "score": []}, dtype="int64")
        vectors = _matrix([*asks["v"], *docs["v"]])
        floor = np.array([_NONE if pd.isna(f) else int(f) for f in asks["floor"]], np.int64)
        index = BlockIndex(docs["id"].to_numpy(np.int64), vectors[len(asks) :])
        query, ids, score, _ = index.search(asks["id"].to_numpy(np.int64), vectors[: len(asks)], k, floor)
        return pd.DataFrame({"query": query, "id": ids, "score": score})

    return search
