"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallywright")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables written between jobs.

    Taken from ``spark.checkpoint.dir``.  Where that is unset, a local-mode
    session gets its own temporary folder; a cluster must name one.
    """
    context = spark.sparkContext
    app = context.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return f"{configured.rstrip('/')}/tallywright/{app}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="tallywright-")
    return _local_folders[app].name


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable without overriding the cluster's choice."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{work_folder(spark)}/checkpoints")
