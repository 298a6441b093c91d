"""Category encoding by label statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import name, number
from daybook.session import cut_lineage

# Fixed value: weight of the overall mean.
PRIOR = 0.5
#: Rows of a table of totals that are broadcast (some 50 bytes each).
_FEW = 200_000


def target_stats(train: DataFrame, category: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Label sum and row count per category."""
    return train.groupBy(*keys, category).agg(
        F.sum(F.col(label).cast("double")).alias("label_sum"), F.count(F.lit(1)).alias("label_count")
    )


def smoothed(label_sum: Column, label_count: Column, mean: Column, prior: float = PRIOR) -> Column:
    return (label_sum + prior * mean) / (label_count + prior)


def ordered_target_encode(
    train: DataFrame, categories: Sequence[str], label: str, prior: float = PRIOR
) -> DataFrame:
    """Encode train rows account by account from earlier days of the same category only.

    Adds ``<category>_enc``. Windows run over one account's days, which the calendar bounds; for one
    encoding over all accounts together see ``ordered_target_encode_pooled``.
    """
    value = F.col(label).cast("double")
    mean = F.avg(value).over(Window.partitionBy("account_id"))
    encoded = {}
    for c in categories:
        before = (
            Window.partitionBy("account_id", c).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
        )
        seen_sum = F.coalesce(F.sum(value).over(before), F.lit(0.0))
        encoded[f"{c}_enc"] = smoothed(seen_sum, F.count(value).over(before), mean, prior)
    return train.withColumns(encoded)


def day_slot(account: Column, digits: int = 3) -> Column:
    """A hash slot that spreads the accounts of one day over ``16 ** digits`` groups."""
    return F.substring(F.md5(account.cast("string")), 1, digits)


def ordered_target_encode_pooled(
    train: DataFrame, categories: Sequence[str], label: str, prior: float = PRIOR, slot_digits: int = 3, pieces: int | None = None
) -> DataFrame:
    """Encode train rows of all accounts as one series in the order (day, slot, account); adds ``<category>_enc``.

    A weekday holds a seventh of all rows, so no window may span a category. The rows are shuffled once, into ``pieces``
    ranges of the series (as many as shuffles have unless given), where one pass over each range adds up what came before
    a row for all categories. What the ranges before hold comes from the totals per range and category, a small table that
    is broadcast once it was counted to be small, and joined as it is otherwise. The ranged rows are written, so the
    source is read once, beside the sample that the bounds of the ranges come from.
    """
    kept = cut_lineage(_ranged(train, categories, label, slot_digits, pieces)).rows
    cells = ", ".join(f"struct({i} AS f, string({name(c)}) AS v)" for i, c in enumerate(categories))
    totals = (
        kept.selectExpr("__piece", "__y", f"inline(array({cells}))")
        .groupBy("f", "v", "__piece")
        .agg(F.coalesce(F.sum("__y"), F.lit(0.0)).alias("s"), F.count(F.lit(1)).alias("k"), F.count("__y").alias("known"))
    )
    before = "OVER (PARTITION BY f, v ORDER BY __piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = cut_lineage(
        totals.selectExpr("f", "v", "__piece", "s", "known", f"coalesce(sum(s) {before}, 0D) AS base_s", f"coalesce(sum(k) {before}, 0L) AS base_k")
    ).rows
    size, label_sum, known = offsets.filter("f = 0").agg(F.count(F.lit(1)), F.sum("s"), F.sum("known")).first()
    mean = F.lit(label_sum / known if known else None).cast("double")
    small = size * len(categories) <= _FEW or offsets.count() <= _FEW
    frame = kept
    for i, c in enumerate(categories):
        own = offsets.filter(F.col("f") == i).select(F.col("v").alias("__v"), F.col("__piece").alias("__at"), "base_s", "base_k")
        match = (F.col("__piece") == F.col("__at")) & F.col(c).cast("string").eqNullSafe(F.col("__v"))
        frame = frame.join(F.broadcast(own) if small else own, match).withColumn(
            f"{c}_enc", smoothed(F.col("base_s") + F.col(f"__s{i}"), F.col("base_k") + F.col(f"__k{i}"), mean, prior)
        ).drop("__v", "__at", "base_s", "base_k", f"__s{i}", f"__k{i}")
    return frame.select(*[F.col(name(c)) for c in train.columns], *[f"{c}_enc" for c in categories])


def _ranged(train: DataFrame, categories: Sequence[str], label: str, slot_digits: int, pieces: int | None) -> DataFrame:
    """The rows in ranges of the series: ``__piece``, the label as ``__y``, and per category the label sum ``__s`` and the
    number of rows ``__k`` before a row in its range."""
    order = ["day", "__slot", "account_id"]
    pieces = pieces or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slotted = train.withColumns({"__slot": day_slot(F.col("account_id"), slot_digits), "__y": F.col(label).cast("double")})
    ranged = slotted.repartitionByRange(pieces, *order).sortWithinPartitions(*order).drop("__slot").withColumn("__piece", F.spark_partition_id())
    schema = T.StructType(
        ranged.schema.fields
        + [T.StructField(f"__{kind}{i}", T.DoubleType() if kind == "s" else T.LongType()) for i in range(len(categories)) for kind in "sk"]
    )
    places = [ranged.columns.index(c) for c in categories]
    at_y = ranged.columns.index("__y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[dict] = [{} for _ in places]
        for batch in batches:
            y = pc.fill_null(batch.column(at_y), 0.0).to_numpy(zero_copy_only=False)
            added = []
            for place, known in zip(places, seen):
                coded = batch.column(place).dictionary_encode(null_encoding="encode")
                values, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
                rows = np.argsort(code, kind="stable")
                first = np.searchsorted(code[rows], np.arange(len(values)))
                sums, counts = np.empty(len(y)), np.empty(len(y), np.int64)
                for value, low, high in zip(values, first, [*first[1:], len(rows)]):
                    at = rows[low:high]
                    s, k = known.get(value, (0.0, 0))
                    running = np.cumsum(np.r_[s, y[at]])
                    sums[at], counts[at] = running[:-1], k + np.arange(len(at))
                    known[value] = (float(running[-1]), k + len(at))
                added += [pa.array(sums), pa.array(counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return ranged.mapInArrow(run, schema)


def target_encode_by_account(
    table: DataFrame, categories: Sequence[str], label: str, prior: float = PRIOR
) -> DataFrame:
    """Encode all rows from the train rows of their own account; a category not seen in training gets the mean.

    Windows over the account's days take the place of joins, so a table that is partitioned by account stays so.
    """
    known = f"IF(part = 'train', double({name(label)}), NULL)"
    mean = f"avg({known}) OVER (PARTITION BY account_id)"
    encoded = {}
    for c in categories:
        over = f"OVER (PARTITION BY account_id, {name(c)})"
        encoded[f"{c}_enc"] = F.expr(
            f"(coalesce(sum({known}) {over}, 0D) + {number(prior)} * {mean}) / (count({known}) {over} + {number(prior)})"
        )
    return table.withColumns(encoded)


def target_encode(
    rows: DataFrame, train: DataFrame, categories: Sequence[str], label: str, prior: float = PRIOR
) -> DataFrame:
    """Encode rows from all train rows; a category not seen in training gets the mean.

    The statistics have one row per category value. Spark broadcasts them when their measured size allows and
    shuffles both sides otherwise.
    """
    value = F.col(label).cast("double")
    mean = F.lit(float(train.agg(F.avg(value)).first()[0]))
    encoded = rows
    for c in categories:
        label_sum, count = F.coalesce(F.col("label_sum"), F.lit(0.0)), F.coalesce(F.col("label_count"), F.lit(0))
        encoded = (
            encoded.join(target_stats(train, c, label), [c], "left")
            .withColumn(f"{c}_enc", smoothed(label_sum, count, mean, prior))
            .drop("label_sum", "label_count")
        )
    return encoded
