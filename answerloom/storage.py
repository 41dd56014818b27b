"""Written intermediate tables.

A table that several jobs read is written as Parquet below the shared folder the cluster names in
``spark.checkpoint.dir``. That cuts lineage like a checkpoint does, survives the loss of any executor, and keeps
column pruning and filter pushdown for the readers.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Rows of a narrow table that may be broadcast. Larger tables are joined by shuffle.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's, or on a local master a new one under /tmp."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_run: ContextVar[str] = ContextVar("run", default="")


@contextmanager
def run_tables(spark: SparkSession) -> Iterator[str]:
    """Tables written inside go to a folder of their own, which is deleted on the way out, and with it what reads them.

    Write results elsewhere before leaving. Without it tables stay until the shared folder's own retention.
    """
    folder = f"run-{uuid.uuid4().hex}"
    outer = _run.set(folder)
    path = f"{shared_folder(spark).rstrip('/')}/{folder}"
    try:
        yield path
    finally:
        _run.reset(outer)
        delete_path(spark, path)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    parts = (shared_folder(spark).rstrip("/"), _run.get(), f"{name}-{uuid.uuid4().hex}")
    return "/".join(p for p in parts if p)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and return that table."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more, not even a plan that has yet to run."""
    for table in tables:
        delete_path(table.sparkSession, table.written_to)


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
