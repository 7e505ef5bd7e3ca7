"""Tables written to the cluster's shared folder, used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only a local-mode session without that setting gets a folder of its own;
    on a cluster the setting is required, since a machine-local folder would
    be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder (or the current `scratch`) that no other call returns."""
    return f"{_scratch.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """Tables written inside are removed at the end.

    For steps whose outcome is written too, to a path taken before: nothing that is read later may
    depend on the tables of the scratch.
    """
    path = fresh_path(spark, label)
    token = _scratch.set(path)
    try:
        yield path
    finally:
        _scratch.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and continue from the files.

    Unlike cached blocks the files survive the loss of any executor, and later
    passes read only the columns they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
