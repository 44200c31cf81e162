"""Spark session helpers.

Cluster jobs get their settings from the submitter; :func:`get_session` only
fills in what is unset, so the same code runs in tests (``local[*]``) and on a
cluster.  Lineage cuts and scratch tables go under ``spark.checkpoint.dir`` —
the shared folder the cluster names — never a machine-local temp folder.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "homeledger") -> SparkSession:
    """Return the active session, creating a local one for tests if needed."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("HOMELEDGER_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Where none is set a local session gets a scratch folder, removed at exit;
    any other session is refused, as its executors could not see one.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="homeledger-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when the write that made them is over, not when the driver happens to collect its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scope:
    """Tables written while it is open; those that no kept frame reads are removed when it closes."""

    def __init__(self):
        self.paths, self.kept = [], []

    def keep(self, *frames):
        """Frames that are read after the scope; returns the first."""
        self.kept += frames
        return frames[0] if frames else None

    def clear(self, spark: SparkSession, *frames):
        """Remove now what was written so far and neither the kept nor the given frames read."""
        # by the folder's own name: listings write schemes and authorities in several ways
        folders = {part for df in (*self.kept, *frames) for f in df.inputFiles() for part in f.split("/")}
        left = [path for path in self.paths if path.rstrip("/").rsplit("/", 1)[-1] in folders]
        for path in self.paths:
            if path not in left:
                discard(spark, path)
        self.paths = left


class _Open(threading.local):
    """The open scopes of a thread."""

    def __init__(self):
        self.scopes: list[Scope] = []


_OPEN = _Open()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the tables that steps inside wrote for one another.

    Frames are lazy: whatever is read after the scope must be given to
    :meth:`Scope.keep`.  Where the steps fail, all tables stay.
    """
    scope = Scope()
    _OPEN.scopes.append(scope)
    try:
        yield scope
    finally:
        _OPEN.scopes.remove(scope)
    scope.clear(spark)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that is no longer read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_scratch(df, path: str, mode: str = "errorifexists", kept: bool = False, **options) -> str:
    """Write a scratch table and drop the shuffle files of the job; the open scopes may remove it unless it is ``kept``."""
    spark = df.sparkSession
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.mode(mode).options(compression="zstd", **options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    for scope in [] if kept else _OPEN.scopes:
        scope.paths.append(path)
    return path


def is_filtered_table(df) -> bool:
    """Whether ``df`` is one stored table with nothing but filters and projections on it: cheaper to read again than to copy."""
    nodes = [line.strip(" :+-").split("(")[0].split(" ")[0]
             for line in df._jdf.queryExecution().optimizedPlan().toString().strip().split("\n")]
    return set(nodes) <= {"Project", "Filter", "Relation"} and nodes.count("Relation") == 1


def materialize(df, name: str):
    """Cut lineage with a written Parquet table in the shared checkpoint folder.

    Like a reliable checkpoint it survives executor loss, and the re-read is a
    file scan with a known size (so size checks keep working) that prunes
    columns and pushes filters.
    """
    spark = df.sparkSession
    return spark.read.parquet(write_scratch(df, scratch_path(spark, name)))
