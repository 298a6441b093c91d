"""Packing of token sequences into windows of fixed capacity with minimum slack."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import slices
from daybook.llm.tokens import Pieces

#: Pieces of one length that are numbered together.
_SHARE = 20_000


def plan_windows(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how many windows, {length: pieces of it in each}): windows filled as close to ``capacity`` as can be.

    Each window takes the longest remaining length; a bitset holds the sums that the others reach, one shift per
    doubling of a length's count. The highest sum that fits is walked back to the counts. The same filling is used
    for as many windows as the counts allow, so the plan depends on the lengths, not on the number of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    full = (1 << (capacity + 1)) - 1
    plan = []
    while left:
        longest = max(left)
        room = capacity - longest
        lengths = sorted((x for x in left if x <= room), reverse=True)
        reached, steps = 1, []
        for length in lengths:
            copies = min(left[length] - (length == longest), room // length)
            step = 1
            while copies > 0 and not reached >> room & 1:
                step = min(step, copies)
                steps.append((length, step, reached))
                reached |= reached << (length * step) & full
                copies -= step
                step *= 2
            if reached >> room & 1:
                break
        reached &= (1 << (room + 1)) - 1
        at = reached.bit_length() - 1
        window = {longest: 1}
        for length, step, before in reversed(steps):
            if not before >> at & 1:
                window[length] = window.get(length, 0) + step
                at -= length * step
        times = min(left[x] // n for x, n in window.items())
        plan.append((times, window))
        for x, n in window.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return plan


def pieces_of(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_column: str = "doc_id", text_column: str = "text",
    view: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None = None,
) -> DataFrame:
    """(id, start, length, ids array<int>, doc_tokens): the ids of each whole text, then ``end_id``, cut every ``capacity`` ids.

    A null or empty text has the end id alone, rows that repeat an id or a whole row have their own pieces, an empty
    table has none; other columns are not read. ``view`` (a function of such batches, the schema of what it returns)
    says what leaves the task instead, so that ids that are only digested need not.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    shape, schema = view or (lambda batch: batch, f"id {kind}, start long, length long, ids array<int>, doc_tokens long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Pieces.of(vocabulary)
        for part in slices(batches, "text", 4 << 20, 4096):
            yield shape(_cut(part.column(0), *tokens.ids(part.column(1)), end_id, capacity))

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, schema)


def _cut(keys: pa.Array, ids: np.ndarray, bounds: np.ndarray, end_id: int, capacity: int) -> pa.RecordBatch:
    totals = np.diff(bounds) + 1
    closed = np.insert(ids, bounds[1:], end_id)
    pieces = -(-totals // capacity)
    row = np.repeat(np.arange(len(totals)), pieces)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
    length = np.minimum(capacity, totals[row] - start)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)], pa.int32()), pa.array(closed.astype(np.int32, copy=False)))
    columns = [keys.take(pa.array(row)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), lists, pa.array(totals[row], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["id", "start", "length", "ids", "doc_tokens"])


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (id, start, length: long, 1 to ``capacity``) plus ``sequence_id`` and ``offset`` in the sequence, both long.

    The lengths' counts, ``capacity`` numbers at most, are planned on the driver. Pieces of a length are numbered in
    shares of about 20,000, so that a length which a third of all pieces have is many small tasks; a piece's number
    says which window of the plan it fills. Repeated rows all get a place.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    plans = _slots(plan_windows(counts, capacity))
    # One row per length: a bounded table, whatever the input.
    lengths = F.broadcast(
        spark.createDataFrame(
            [(length, max(1, counts[length] // _SHARE), plan) for length, plan in plans.items()],
            "length long, __shares long, __plan array<struct<low: long, high: long, each: long, window: long, at: long>>",
        )
    )
    # A share is a hash of the piece's key, so it is the same each time it is computed.
    dealt = pieces.join(lengths, "length").withColumn("__share", F.pmod(F.xxhash64("id", "start"), F.col("__shares")).cast("int"))
    sums = dealt.groupBy("length", "__share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select("length", "__share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    own = Window.partitionBy("length", "__share").orderBy("id", "start")
    numbered = dealt.withColumn("__nth", F.row_number().over(own) - 1).join(firsts, ["length", "__share"])
    numbered = numbered.withColumn("__nth", F.col("__nth") + F.col("__first"))
    placed = numbered.withColumn("__slot", F.expr("filter(__plan, s -> __nth >= s.low AND __nth < s.high)[0]"))
    within = "(__nth - __slot.low)"
    return placed.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        F.expr(f"__slot.window + cast(floor({within} / __slot.each) AS long)").alias("sequence_id"),
        F.expr(f"__slot.at + {within} % __slot.each * length").alias("offset"),
    )


def _slots(plan: list[tuple[int, dict[int, int]]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length its fillings: numbers [low, high) of its pieces, pieces per window, first window, first offset."""
    rows: dict[int, list] = {}
    window = 0
    for times, filling in plan:
        at = 0
        for length, each in sorted(filling.items(), reverse=True):
            own = rows.setdefault(length, [])
            low = own[-1][1] if own else 0
            own.append((low, low + each * times, each, window, at))
            at += each * length
        window += times
    return rows


def padding(sequences: DataFrame, capacity: int) -> DataFrame:
    """(sequences, tokens, padding): a sequence is padded to ``capacity`` unless its length is a power of two."""
    filled = sequences.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    pad = F.expr(f"CASE WHEN used & (used - 1) = 0 THEN 0 ELSE {capacity} - used END")
    return filled.agg(F.count("*").alias("sequences"), F.sum("used").alias("tokens"), F.sum(pad).alias("padding"))
