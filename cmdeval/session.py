"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cmdeval", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's own session."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Scoring after a shuffle is CPU-bound: keep small shuffles split over the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CMDEVAL_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    The cluster names it. Only a local session, all of whose tasks share this
    machine, may do without: it gets a folder of its own, registered as the
    checkpoint dir. On a cluster a missing folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="cmdeval-shared-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside leave no shuffle files to the driver's garbage collector: for steps that end in files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


_SHIPPED: set[str] = set()


def ensure_package_on_workers(spark: SparkSession) -> None:
    """Make ``cmdeval`` importable in Python workers (once per application).

    When the shared folder is a local path (local mode, tests) the package is
    zipped there and added with ``addPyFile``. On a cluster, ship it with
    ``--py-files`` or install it on the executors.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    base = shared_dir(spark)
    scheme, colon, rest = base.partition(":")
    if colon and scheme != "file":  # hdfs:/x as well as hdfs://host/x
        _SHIPPED.add(app)
        return
    local = os.path.normpath("/" + rest.lstrip("/")) if colon else base
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(local, f"pyfiles-{uuid.uuid4().hex}")
    os.makedirs(target, exist_ok=True)
    archive = shutil.make_archive(os.path.join(target, "cmdeval"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="cmdeval")
    sc.addPyFile(archive)
    _SHIPPED.add(app)
