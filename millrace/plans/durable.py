"""Intermediate tables that survive executor loss.

Iterative operators cut their lineage by writing a parquet table into the shared folder
that the cluster names in ``spark.checkpoint.dir``.  Parquet rather than an RDD checkpoint:
later rounds read only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, visible to every executor."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


# Tables written inside the scopes that are open now, innermost last; every thread has its own.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def materialise(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Inside ``temporary`` the table is removed at the end of the scope, or with ``outlives`` at the
    end of the scope around it.
    """
    path = new_path(df.sparkSession, label)
    open_scopes = _scopes.get()[:-1] if outlives else _scopes.get()
    if open_scopes:
        open_scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside, once no table that outlives the scope needs them."""
    own: list[str] = []
    before = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(before)
        for path in own:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table wherever it is stored."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written_bytes(table: DataFrame) -> int:
    """Bytes of the files that a written table is read from."""
    spark, total = table.sparkSession, 0
    for file in table.inputFiles():
        where = spark._jvm.org.apache.hadoop.fs.Path(file)
        total += where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getLen()
    return total
