"""Tables written once within a job and read several times."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_THIS_MACHINE = re.compile(r"local(\[.*\])?")  # a local cluster is one of processes
SHARED_FOLDER = "spark.checkpoint.dir"
_LOCAL_FOLDER = "tapeline.local.folder"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read, as the cluster names it.

    Only a session on the local machine may do without the setting; a temporary
    folder is then set for the rest of the session.
    """
    folder = spark.conf.get(SHARED_FOLDER, None) or spark.conf.get(_LOCAL_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if not _THIS_MACHINE.fullmatch(spark.conf.get("spark.master", "")):
        raise ValueError(f"set {SHARED_FOLDER} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tapeline-")
    spark.conf.set(_LOCAL_FOLDER, folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/tapeline/{name}-{uuid.uuid4().hex}"
    for paths in _scopes:
        paths.append(path)
    return path


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` to the shared folder and read them back.

    The result has no lineage left to recompute when an executor is lost, each
    reader scans only its own columns, and the planner knows the true size, so
    it broadcasts the table only when it is small enough.
    """
    spark = rows.sparkSession
    path = staging_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


_scopes: list[list[str]] = []


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged within the block when it ends, however it ends."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes[:] = [scope for scope in _scopes if scope is not paths]
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
