"""Intermediate results on shared storage.

A staged frame is a plain Parquet copy in the folder the cluster names in ``spark.checkpoint.dir``: it cuts lineage,
survives the loss of any executor, keeps column pruning and gives AQE true sizes.  Nothing is kept in executor-local
blocks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
_local_fallback: dict[str, str] = {}
_held: ContextVar[list[str] | None] = ContextVar("held", default=None)  # paths to drop when the work around them is done


def shared_dir(spark: SparkSession) -> str:
    """Folder reachable by every executor, read from the session."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage")
    # Single-machine runs only: driver and executors are one process.
    if context.applicationId not in _local_fallback:
        _local_fallback[context.applicationId] = tempfile.mkdtemp(prefix="meterlake-")
    return _local_fallback[context.applicationId]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path for one intermediate result."""
    return f"{shared_dir(spark)}/meterlake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Evaluate ``df`` once, write it as Parquet, and continue from the written copy."""
    path = stage_path(df.sparkSession, name)
    if (held := _held.get()) is not None:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(builders: list[Callable[[], T]], at_once: int = 4) -> list[T]:
    """Run independent builders in threads of the driver, so that the jobs they start share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda build, context: context.run(build), builders, [copy_context() for _ in builders]))


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Drop what is staged inside, by this thread and by `side_by_side`, at the end; nothing lazy may outlive it unwritten."""
    paths: list[str] = []
    token = _held.set(paths)
    try:
        yield
    finally:
        _held.reset(token)
        for path in paths:
            drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Drop every frame this application staged; call when no staged frame is needed any more."""
    drop(spark, f"{shared_dir(spark)}/meterlake/{spark.sparkContext.applicationId}")
