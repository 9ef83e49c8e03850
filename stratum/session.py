"""Session construction and shared-storage helpers.

Cluster settings are owned by whoever launches the job; these helpers only
fill in what is missing. The checkpoint folder is always taken from
``spark.checkpoint.dir`` when the cluster names one, so lineage cuts and
scratch tables land on shared storage that survives executor loss.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_scope = threading.local()  # the open scratch scope of each thread

# Defaults for a single-node session (tests, bench). On a cluster the
# launcher's values win because ``getOrCreate`` keeps an existing session.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_freeing: dict[int, tuple[int, str | None]] = {}  # blocks open on a session, and its own setting


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "stratum") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or cores))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Order of preference: the context's current directory, then
    ``spark.checkpoint.dir`` from the session config. Only a local-mode
    session without either gets a fresh temporary folder; on a cluster a
    missing setting is an error rather than a silent machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for "
                "checkpoints and scratch tables")
        configured = tempfile.mkdtemp(prefix="stratum-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base.rstrip("/"), "stratum-scratch",
                        f"{name}-{uuid.uuid4().hex[:12]}")
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


def free(spark: SparkSession, path: str) -> None:
    """Remove a folder from the store it is in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made by this thread inside the block are removed at its
    end. Results that still read them must be stored before."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        for path in paths:
            free(spark, path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside the block, an execution's shuffle files are removed when it ends. Else
    they stay until the driver happens to collect its garbage, which a build of many
    stored tables with a large heap may not do before its end. Blocks may nest and
    overlap; the session's own setting comes back with the last one."""
    session = id(spark._jsparkSession)
    with _lock:
        count, own = _freeing.get(session) or (0, spark.conf.get(_FREE_SHUFFLES, None))
        _freeing[session] = count + 1, own
        spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            count, own = _freeing.pop(session)
            if count > 1:
                _freeing[session] = count - 1, own
            elif own is None:
                spark.conf.unset(_FREE_SHUFFLES)
            else:
                spark.conf.set(_FREE_SHUFFLES, own)
