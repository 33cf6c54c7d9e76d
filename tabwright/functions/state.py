"""Handling of small fitted state and of long lineages."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Least and most rows for a task of a trainer.
ROWS_WORTH_A_TASK = 1_000
ROWS_PER_TASK = 1_000_000
# Most rows a fitted frame may have to be brought to the driver.
MAX_STATE_ROWS = 10_000
_LOCAL_FOLDERS: dict[str, tempfile.TemporaryDirectory] = {}


def local_frame(spark: SparkSession, table: pa.Table) -> DataFrame:
    """A frame whose exact size Catalyst knows, so it decides by itself whether to broadcast it."""
    return spark.createDataFrame(table)


def settle(df: DataFrame, max_rows: int = MAX_STATE_ROWS) -> DataFrame:
    """Compute a fitted frame once.

    Up to ``max_rows`` rows it becomes a local relation, which joins without a shuffle. A larger
    one (say, the codes of a column with millions of categories) is checkpointed and
    stays distributed; joins to it are then shuffle joins, with AQE splitting hot keys.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows:
        return local_frame(df.sparkSession, head)
    return cut_lineage(df)


def rows_if_small(df: DataFrame, max_rows: int = MAX_STATE_ROWS) -> list[dict] | None:
    """Rows of a settled frame, or None when there are too many (no job for a local relation)."""
    head = df.limit(max_rows + 1).toArrow()
    return head.to_pylist() if head.num_rows <= max_rows else None


def small_rows(df: DataFrame, what: str, max_rows: int = MAX_STATE_ROWS) -> list[dict]:
    """Rows of a frame that must be small by nature (classes, feature names); an error if it is not."""
    rows = rows_if_small(df, max_rows)
    if rows is None:
        raise ValueError(f"{what}: more than {max_rows} rows, too many for driver-side state")
    return rows


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; in local mode, where it may be unset, a temporary one for
    each application, which is removed when Python ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        own = spark.sparkContext.applicationId
        if own not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[own] = tempfile.TemporaryDirectory(prefix="tabwright-", ignore_cleanup_errors=True)
        folder = _LOCAL_FOLDERS[own].name
    return qualified(spark, folder)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the cluster's file system, so that readers other than Spark find the same one.

    A path without a scheme means the default file system to Spark, and the machine's own disk to everything else.
    """
    if "://" in folder:
        return folder
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return folder if system.getScheme() == "file" else system.makeQualified(path).toString()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table that is written and read back."""
    return f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later steps start from stored rows, also when executors are lost."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over tasks for a trainer, and stored; a trainer reads its input once for every level of its trees.

    Files and joins give as many tasks as their bytes ask for, which leaves most cores of a cluster without work. A
    small table has one task for each core, a larger one a multiple of that.
    """
    cores, rows = df.sparkSession.sparkContext.defaultParallelism, df.count()
    tasks = min(cores, max(1, rows // ROWS_WORTH_A_TASK)) * max(1, -(-rows // (cores * ROWS_PER_TASK)))
    return cut_lineage(df.repartition(tasks))
