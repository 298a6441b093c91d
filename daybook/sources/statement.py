"""Statement sources. Every reader yields ``account_id LONG, ts TIMESTAMP_NTZ, amount DECIMAL(18,2)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The header texts and the time pattern of the statement file.
TIME_HEADER = "Дата i час операції"
AMOUNT_HEADER = "Сума в валюті картки (UAH)"
# Reads padded and unpadded parts alike.
TIME_PATTERN = "d.M.yyyy H:m:s"

MONEY = T.DecimalType(18, 2)
CORRUPT = "_corrupt_record"

STATEMENT_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("amount", MONEY),
    ]
)


def coerce_amount(text: Column, lenient: bool = False) -> Column:
    """Text to money. A bad text raises, or becomes null when ``lenient``."""
    return text.try_cast(MONEY) if lenient else text.cast(MONEY)


def parse_timestamp(text: Column, lenient: bool = False) -> Column:
    """``dd.mm.yyyy hh:mm:ss`` to a timestamp without zone. A bad text raises, or becomes null when ``lenient``."""
    if lenient:
        return F.try_to_timestamp(text, F.lit(TIME_PATTERN)).cast("timestamp_ntz")
    return F.to_timestamp_ntz(text, F.lit(TIME_PATTERN))


def format_timestamp(ts: Column) -> Column:
    """A timestamp without zone as ``dd.mm.yyyy hh:mm:ss``, untouched by the session zone."""
    text = ts.cast("string")
    day, month, year = F.substring(text, 9, 2), F.substring(text, 6, 2), F.substring(text, 1, 4)
    return F.concat(F.concat_ws(".", day, month, year), F.lit(" "), F.substring(text, 12, 8))


def read_statement_csv(
    spark: SparkSession,
    path: str,
    account: int | str = 0,
    lenient: bool = False,
    time_header: str = TIME_HEADER,
    amount_header: str = AMOUNT_HEADER,
    header_names: list[str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Scan statement files.

    ``account`` is either a constant id or the name of a column that holds it. All columns are read as
    text under a fixed schema taken from the header line, or from ``header_names`` without a look at a file, so nothing
    is inferred from the data. Every file's header line must have those names in that order, else the read raises: columns
    are never bound by position alone. With ``lenient`` unreadable rows keep null fields, otherwise they raise;
    ``keep_corrupt`` adds ``_corrupt_record``, the line of a row with too few or too many fields.
    """
    names = header_names or spark.read.option("header", True).csv(path).columns
    fields = [T.StructField(c, T.StringType()) for c in (*names, *([CORRUPT] if keep_corrupt else []))]
    raw = (
        spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    )
    owner = F.col(f"`{account}`").cast("long") if isinstance(account, str) else F.lit(account).cast("long")
    return raw.select(
        owner.alias("account_id"),
        parse_timestamp(F.col(f"`{time_header}`"), lenient).alias("ts"),
        coerce_amount(F.col(f"`{amount_header}`"), lenient).alias("amount"),
        *([F.col(CORRUPT)] if keep_corrupt else []),
    )


def write_statement_csv(statement: DataFrame, path: str) -> None:
    """Write a statement in the file format that ``read_statement_csv`` takes."""
    statement.select(
        F.col("account_id"),
        format_timestamp(F.col("ts")).alias(TIME_HEADER),
        F.col("amount").cast("string").alias(AMOUNT_HEADER),
    ).write.mode("errorifexists").option("header", True).csv(path)


def statement_from_events(spark: SparkSession, folder: str, spending_only: bool = False) -> DataFrame:
    """The events table as a statement: sign-ups play income, all else is spending.

    ``spending_only`` adds the raw-column form of the spending filter, which reaches the Parquet scan;
    the exact filter on the rounded amount still follows in ``keep_spending``.
    """
    raw = spark.read.parquet(f"{folder}/events.parquet")
    if spending_only:
        raw = raw.filter((F.col("event_type") != "signup") & (F.col("value") > 0))
    signed = F.when(F.col("event_type") == "signup", F.col("value")).otherwise(-F.col("value"))
    return raw.select(F.col("user_id").alias("account_id"), "ts", signed.cast(MONEY).alias("amount"))


def statement_from_orders(spark: SparkSession, folder: str, spending_only: bool = False) -> DataFrame:
    """The orders table as the statement of one account: pending orders play income."""
    raw = spark.read.parquet(f"{folder}/orders.parquet")
    if spending_only:
        raw = raw.filter((F.col("o_orderstatus") != "P") & (F.col("o_totalprice") > 0))
    signed = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).otherwise(-F.col("o_totalprice"))
    return raw.select(
        F.lit(0).cast("long").alias("account_id"),
        F.col("o_orderdate").alias("ts"),
        signed.cast(MONEY).alias("amount"),
    )
