"""Sharding by minimax contiguous partition, with DataFrame functions only."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import literal_rows, written

#: Rows of one bucket of an order, and how many buckets there are at most (then they hold more rows).
_BUCKET = 20_000
_MOST_BUCKETS = 50_000
#: Capacities that one round of the search tries at once.
_TRIES = 64


def _bucketed(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """``df`` as a written table in which ``__bucket`` numbers ranges of the order."""
    n = min(_MOST_BUCKETS, max(1, -(-rows // _BUCKET)))
    ranged = df.repartitionByRange(n, *order) if n > 1 else df.coalesce(1)
    return written(ranged.withColumn("__bucket", F.spark_partition_id()), "shards")


class Steps:
    """Atomic groups in their order: for each bucket the ascending sums of sizes at which a shard may end.

    Buckets are rows of one array each; the driver holds two numbers per bucket.
    """

    def __init__(self, groups: DataFrame):
        ordered = groups.groupBy("__bucket").agg(F.sort_array(F.collect_list("until")).alias("ends"), F.min(F.col("until") - F.col("size")).alias("begin"), F.max("size").alias("largest"))
        self.table = written(ordered, "shards")
        rows = sorted((r[1], r[0], r[2], r[3]) for r in self.table.select("__bucket", "begin", F.expr("ends[size(ends) - 1]").alias("end"), "largest").collect())
        self.begins, self.buckets = [r[0] for r in rows], [r[1] for r in rows]
        self.total = max((r[2] for r in rows), default=0)
        self.largest = max((r[3] for r in rows), default=0)

    def last_ends(self, limits: dict[int, int]) -> dict[int, int]:
        """key -> limit to key -> the last end that isn't above the limit."""
        found = {key: self.total for key, limit in limits.items() if limit >= self.total}
        rows = []
        for key, limit in limits.items():
            if key not in found:
                at = bisect_right(self.begins, limit) - 1
                rows.append((self.buckets[at], key, limit, self.begins[at]))
        if rows:
            asked = literal_rows(self.table.sparkSession, ["__bucket", "k", "upto", "begin0"], rows)
            best = F.expr("array_max(filter(ends, e -> e <= upto))")
            answers = self.table.where(F.col("__bucket").isin(sorted({r[0] for r in rows}))).join(F.broadcast(asked), "__bucket")
            found |= {r[0]: r[1] for r in answers.select("k", F.coalesce(best, "begin0")).collect()}
        return found

    def fill(self, capacities: list[int], shards: int) -> dict[int, list[int]]:
        """Greedy cuts for each capacity: every shard takes groups as long as they fit."""
        cuts = {c: [0] for c in capacities}
        for _ in range(shards):
            open_ = {c: at[-1] + c for c, at in cuts.items() if at[-1] < self.total}
            if not open_:
                break
            for c, end in self.last_ends(open_).items():
                cuts[c].append(end)
        return {c: at[1:] for c, at in cuts.items()}


def smallest_capacity(steps: Steps, shards: int) -> tuple[int, list[int]]:
    """(capacity, cuts): the least capacity at which ``shards`` contiguous shards hold all groups, and where they end.

    It lies between the larger of mean and largest group, and the sum of both. Each round of the search fills 64
    capacities of the range greedily at once and goes on between the last that fails and the first that fits.
    """
    if not steps.total:
        return 0, []
    mean = -(-steps.total // shards)
    low, high = max(steps.largest, mean), mean + steps.largest
    best = (high, steps.fill([high], shards)[high])
    while low < high:
        tries = sorted({low + (high - low) * i // _TRIES for i in range(_TRIES)})
        filled = steps.fill(tries, shards)
        good = [c for c in tries if filled[c] and filled[c][-1] == steps.total]
        if good:
            best, high = (good[0], filled[good[0]]), good[0]
        failed = [c for c in tries if c < high]
        low = failed[-1] + 1 if failed else high
    return best


def sharded(docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every document in one of ``shards`` shards of near equal bytes.

    A document's size is its text's UTF-8 bytes (null: none) plus one. Equal texts (null texts among themselves) are one
    atomic group; groups are ordered by their smallest id and cut into contiguous shards whose largest is as small as can
    be. A group heavier than the mean fills a shard of its own size. Slots run from 0 without a gap in each shard, in the
    order of ids. Repeated rows all get a slot. Only narrow rows (no text) are shuffled, and sums over groups and slots are
    taken per bucket first, so a text or source that a third of all rows have is no task of its own; its rows meet their shard in a
    join that adaptive execution may split.
    """
    text = F.col(text_column)
    rows = written(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("null")).alias("digest"),
        ),
        "shards",
    )
    n = rows.count()
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"), F.min("doc_id").alias("first"))
    groups = _bucketed(groups, n, "first", "digest")
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = groups.groupBy("__bucket").agg(F.sum("size").alias("s")).select("__bucket", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("__bucket").orderBy("first", "digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = written(
        groups.join(offsets, "__bucket").select("digest", "size", "__bucket", (F.sum("size").over(within) + F.col("offset")).alias("until")), "shards"
    )
    _, cuts = smallest_capacity(Steps(groups), shards)
    shard = sum((F.when(F.col("until") > cut, 1).otherwise(0) for cut in cuts[:-1]), F.lit(0)).cast("int")
    placed = _bucketed(rows.join(groups.select("digest", shard.alias("shard")), "digest").drop("digest"), n, "doc_id")
    sums = placed.groupBy("shard", "__bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "__bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    own = Window.partitionBy("shard", "__bucket").orderBy("doc_id", "text_crc32")
    return placed.withColumn("nth", F.row_number().over(own) - 1).join(sums, ["shard", "__bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("nth") + F.col("first")).alias("slot")
    )
