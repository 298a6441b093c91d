"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Rows that are worth a task of a pass.
TASK_ROWS = 1 << 14

_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cpus: str = "*", shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without it: then one scratch folder per application is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="daybook-")
    return _LOCAL_FOLDERS[app]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class WrittenFrame:
    """A frame that lives as a table in the shared folder, so a lost executor only means reading again."""

    rows: DataFrame
    path: str

    def drop(self) -> None:
        """Delete the table; nothing may read ``rows`` afterwards."""
        jvm, conf = self.rows.sparkSession._jvm, self.rows.sparkSession._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(conf).delete(target, True)


def cut_lineage(df: DataFrame) -> WrittenFrame:
    """Write ``df`` to the shared folder and go on from the written table."""
    path = new_folder(df.sparkSession, "frame")
    df.write.parquet(path)
    return WrittenFrame(df.sparkSession.read.schema(df.schema).parquet(path), path)


def few_tasks(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` in as many partitions as ``count`` rows are worth at most; larger tables keep theirs.

    For tables that many passes read, where each task costs more than a few rows do.
    """
    return rows.coalesce(max(1, -(-count // TASK_ROWS)))
