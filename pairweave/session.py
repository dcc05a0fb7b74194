"""Where intermediate data may live, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster a missing setting is an error,
    because data written to one node's disk is lost with that node.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="pairweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_PATHS: list[str] = []
_TABLES: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path inside the shared folder; every call gives another one."""
    _PATHS.append(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _PATHS[-1]


def scratch_table(name: str) -> str:
    """A new table name in the warehouse."""
    _TABLES.append(f"{name}_{uuid.uuid4().hex}")
    return _TABLES[-1]


def remove_scratch(spark: SparkSession) -> None:
    """Delete every path and table that this process took for intermediate data. Call it once the results are written."""
    while _PATHS:
        remove(spark, _PATHS.pop())
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once; later stages start from the files, also after an executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def rewrite(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder; returns it read back, and its path for ``remove``.

    For loops that would otherwise leave one checkpoint per round behind.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table made by ``rewrite`` once nothing reads it any more."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores.

    A scan of a few large row groups would leave most cores idle in the costly text steps that follow. Where the scan
    already has enough splits, as it does on large tables, nothing is moved. Select the needed columns first.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
