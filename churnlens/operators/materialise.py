"""Cut the lineage of a table that several later steps read."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from churnlens.session import ensure_checkpoint_dir

_scope: ContextVar[list[str] | None] = ContextVar("tables of the run", default=None)


def materialise(table: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``table`` once and hand back what was written.

    With a path it becomes a Parquet table that later runs can read as well;
    without one, a Parquet table in the checkpoint folder that all executors share,
    which ends with the ``run_scope`` it was written in, if any.
    Either way it outlives executors, is computed once, has a known size, and
    later scans read only the columns they need.
    """
    spark = table.sparkSession
    if path is None:
        ensure_checkpoint_dir(spark)
        path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid4().hex}"
        held = _scope.get()
        if held is not None:
            held.append(path)
    table.write.mode("overwrite").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that only feed later ones: those materialised in the block are deleted when it
    ends. What the block gives to ``keep`` is written to the enclosing scope (if any) and
    stays, so that it must not be read lazily from the others. The block's plans are then
    collected, so that Spark's cleaner also deletes their shuffle files."""
    outer = _scope.get()

    def keep(table: DataFrame) -> DataFrame:
        token = _scope.set(outer)
        try:
            return materialise(table)
        finally:
            _scope.reset(token)

    try:
        with run_scope(spark):
            yield keep
    finally:
        gc.collect()
        spark.sparkContext._jvm.System.gc()


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables of a run when it ends, whether well or not.

    For steps that write their results: nothing that is read lazily from one of the
    tables may be used after the scope. Scopes nest; each deletes its own tables.
    """
    token = _scope.set([])
    try:
        yield
    finally:
        paths = _scope.get()
        _scope.reset(token)
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
