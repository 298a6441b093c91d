"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import new_folder

#: Rows per table in one slice that a task works on; long texts make slices shorter.
SLICE_ROWS = 512


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is computed once, and a lost executor only means reading again.

    The table stays until the folder named by ``spark.checkpoint.dir`` is emptied, as lazy results may still read it.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few given rows as part of the plan itself; whole numbers are long."""

    def column(name: str, value):
        return (F.lit(value).cast("long") if isinstance(value, int) else F.lit(value)).alias(name)

    structs = [F.struct(*map(column, names, row)) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _give_back() -> None:
    """Return freed memory to the system: a worker lives on for other tasks and other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, target_bytes: int = 4 << 20, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches so that one slice holds about ``target_bytes`` of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.column(batch.schema.get_field_index(column)).nbytes // batch.num_rows)
        step = max(1, min(rows, target_bytes // per_row))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
    _give_back()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; a null text counts as empty."""
    return [text or "" for text in batch.column(batch.schema.get_field_index(column)).to_pylist()]
