"""Session construction and the shared folder used for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# A hash table of this many small rows stays well below Spark's own limits;
# anything that may be larger is left to a shuffled join.
BROADCAST_ROW_LIMIT = 1_000_000


def build_session(app_name: str = "tremorgrid", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on (UTC, AQE)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # wide plans: keep the generated code of more stages than the default 100
        "spark.sql.codegen.cache.maxEntries": "2000",
        # building the wide plans is faster without a call site per expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder named by ``spark.checkpoint.dir``.

    Only where none is named and everything runs in one process (local tests) a
    temporary folder is set; on a cluster executors would not see each other's.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tremorgrid-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


_scope = threading.local()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one intermediate table inside the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread writes inside are removed at the end.

    For work whose result does not read them any more: fitted models, written
    tables, collected numbers.
    """
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        for path in _scope.paths:
            remove_path(spark, path)
        _scope.paths = outer


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder on whatever file system its path names."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly inside ``path``; none if it does not exist."""
    files, at = _file_system(spark, path)
    if not files.exists(at):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(at) if f.isDirectory())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage reliably: the table survives the loss of any executor, and
    several consumers read it without recomputing what led to it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bound: int) -> DataFrame:
    """Broadcast ``df`` only if its proven row bound is small."""
    return F.broadcast(df) if row_bound <= BROADCAST_ROW_LIMIT else df
