"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on. The session time zone is pinned so that
# formatting and parsing of wall-clock timestamps never depend on the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "weblake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster, pass ``master=None`` and leave ``shuffle_partitions`` unset so the
    cluster defaults and AQE's advisory partition size decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and working tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir). A local master without one gets a scratch folder of its own (tests); on
    any other master the folder must be configured, because executors of a
    cluster do not share a machine's temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("no shared folder: set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="weblake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


_scopes: list[list[str]] = []
_applications: set[str] = set()


def _clear_at_exit(spark: SparkSession) -> None:
    try:
        clear_stages(spark)
    except Exception:   # the context has been stopped before: the folder can no longer be reached
        pass


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder of the shared folder, which is deleted when the
    driver program ends (or with :func:`clear_stages`)."""
    app = spark.sparkContext.applicationId
    if app not in _applications:
        _applications.add(app)
        atexit.register(_clear_at_exit, spark)
    return f"{shared_dir(spark)}/{app}/{name}-{uuid.uuid4().hex}"


def stage(df, name: str = "stage"):
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` (later reads never recompute the
    inputs, and a lost executor only costs re-reading files), but stores the
    rows columnar and compressed, and keeps parquet pushdown on the reread.
    The folder is deleted when the surrounding :func:`staging` scope ends, or
    with :func:`unstage`; a stage that a returned DataFrame still reads belongs
    to no scope and lives in the application's folder.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weblake_stage_path = path
    return out


@contextmanager
def staging(spark: SparkSession):
    """Delete every folder staged inside the block when it ends, also on failure."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            _delete(spark, path)


def unstage(df) -> None:
    """Delete the folder behind a DataFrame returned by :func:`stage` (call once
    every job reading it has finished)."""
    path = getattr(df, "_weblake_stage_path", None)
    if path:
        _delete(df.sparkSession, path)


def clear_stages(spark: SparkSession) -> None:
    """Delete the application's folder of stages (when no result reads them any more)."""
    _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
