"""Intermediate tables in the folder that driver and executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``; each table has
a directory of its own below it. A written table cuts lineage and survives the
loss of executors. Tables belong to the innermost open ``scope`` of the thread that makes them: they go when
they are dropped, when the scope ends (but for those that its result still
reads), or at the latest when the driver exits.
"""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Directories still there, by session-independent URI.
_made: dict[str, SparkSession] = {}


@dataclass(eq=False)
class _Scope:
    uris: list[str] = field(default_factory=list)


#: The innermost open scope of each thread (or task of an event loop): plans that run side by side never share one.
_scope: ContextVar[_Scope | None] = ContextVar("scope", default=None)

#: Spark's setting by which a statement deletes its shuffle files when it ends; tables being written; the setting before the first of them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ending: list[SparkSession] = []
_before: list[str | None] = []
_lock = threading.Lock()


def shared_base(spark: SparkSession) -> str:
    """URI of the shared folder; a folder of our own only where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
            base = tempfile.mkdtemp(prefix="strataloom-")
        else:
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_strataloom"
        spark.sparkContext.setCheckpointDir(base)
    return f"file://{base}" if base.startswith("/") else base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory URI, owned by the innermost scope."""
    uri = f"{shared_base(spark).rstrip('/')}/strataloom/{name}-{uuid.uuid4().hex}"
    _made[uri] = spark
    if (inner := _scope.get()) is not None:
        inner.uris.append(uri)
    return uri


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, as executors open it."""
    for long in ("s3a://", "s3n://"):
        if uri.startswith(long):
            uri = "s3://" + uri[len(long):]
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Statements begun inside delete their shuffle files when they end; otherwise these stay until the driver collects garbage."""
    with _lock:
        if not _ending:
            _before[:] = [spark.conf.get(_CLEANUP, None)]
            spark.conf.set(_CLEANUP, "true")
        _ending.append(spark)
    try:
        yield
    finally:
        with _lock:
            _ending.pop()
            if not _ending and _before[0] is None:
                spark.conf.unset(_CLEANUP)
            elif not _ending:
                spark.conf.set(_CLEANUP, _before[0])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it: lineage ends there and is
    not recomputed when an executor is lost. Its shuffle files go at once."""
    spark = df.sparkSession
    uri = shared_dir(spark, name)
    with _shuffles_end(spark):
        df.write.mode("overwrite").parquet(uri)
    out = spark.read.schema(df.schema).parquet(uri)
    out._strataloom_uri = uri
    return out


def _delete(uri: str) -> None:
    spark = _made.pop(uri, None)
    if spark is None:
        return
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except (Py4JError, AttributeError, OSError):
        pass  # the session has ended or the store is away: nothing depends on it now


def drop(*tables: DataFrame | None) -> None:
    """Delete tables that ``materialize`` made and nothing reads any more."""
    for t in tables:
        uri = getattr(t, "_strataloom_uri", None)
        if uri:
            _delete(uri)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver notice plans that are no longer used, so that their shuffle files are removed."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables made inside are deleted at the end, also after an error, but for those that
    the frames put in the yielded list read. These pass to the scope around."""
    own, outer = _Scope(), _scope.get()
    results: list[DataFrame] = []
    token = _scope.set(own)
    try:
        yield results
    finally:
        _scope.reset(token)
        read = {os.path.basename(os.path.dirname(f)) for r in results for f in r.inputFiles()}
        kept = [u for u in own.uris if os.path.basename(u) in read]
        for u in own.uris:
            if u not in kept:
                _delete(u)
        if outer is not None:
            outer.uris.extend(kept)
        free_shuffles(spark)


@atexit.register
def _clean() -> None:
    for uri in list(_made):
        path = uri.removeprefix("file://")
        if path.startswith("/"):
            import shutil

            shutil.rmtree(path, ignore_errors=True)
        else:
            _delete(uri)
