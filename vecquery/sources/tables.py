"""Parquet tables in, intermediate tables out.

Intermediate tables live under ``spark.checkpoint.dir``, the folder every executor can reach, so a
job that lost executors reads them again instead of recomputing. Where the setting is missing, only a
local master may fall back to a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def read_table(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    """The table; ``spread_by`` names an id to spread rows by before costly row-local work.

    A table stored in fewer splits than there are cores would leave cores idle. A large table has more
    splits than cores and is not moved. Hashing an id, unlike dealing rows out in turn, gives a rerun
    task the same rows.
    """
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread_by and table.rdd.getNumPartitions() < cores:
        table = table.repartition(cores, spread_by)
    return table


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh temporary one for a local master without the setting."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="vecquery-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path no other run writes to."""
    return f"{_scope.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written while it lasts are removed at its end; results must have been written elsewhere by then."""
    folder = f"{shared_dir(spark)}/passing-{uuid.uuid4().hex}"
    before = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(before)
        remove(spark, folder)


def write_stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, pattern: str) -> None:
    """Remove the files or folders that a path with wildcards names, wherever they are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(path) or ():
        files.delete(found.getPath(), True)
