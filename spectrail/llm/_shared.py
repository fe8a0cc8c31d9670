"""The folder that driver and executors share, and tables written into it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the checkpoint folder that its context has.

    Where neither is set, a session on one machine (tests) gets a fresh temporary folder as its
    checkpoint folder; on a cluster executors wouldn't share it, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if not known:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spectrail-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders of this driver's tables, until ``clear``.
_WRITTEN: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: lineage ends there.

    The files outlive any executor, so a later stage never recomputes ``df``. They stay until ``clear``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Narrow rows of a task.
TASK_ROWS = 100_000


def tasks(rows: int) -> int:
    """Tasks for so many narrow rows: few of them in 200 partitions cost more time to start tasks than to work."""
    return rows // TASK_ROWS + 1


def clear(spark: SparkSession) -> int:
    """Delete the tables that operators have written so far, once their results are used; how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = len(_WRITTEN)
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_prefix(*names: str) -> str:
    """Underscores that no name begins with: for columns that clash with none of these."""
    prefix = "__"
    while any(n.startswith(prefix) for n in names):
        prefix += "_"
    return prefix
