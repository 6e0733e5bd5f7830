"""Spark session settings shared by jobs, tests and the bench.

Every job in the package assumes: UTC session zone (all event timestamps are
wall-clock values without zone), ANSI SQL on (bad casts fail loudly; the few
places that parse raw text use the ``try_*`` functions), adaptive execution on
(runtime coalescing, skew-join splitting, runtime broadcast decisions that are
size-checked against ``spark.sql.autoBroadcastJoinThreshold``) and dynamic
partition overwrite (a reload of one extraction date replaces only that date).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows in one batch to a Python worker: bounds its memory where rows hold whole texts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "wardline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's settings.

    ``master`` is only given by tests and the bench; on a cluster the launcher
    decides it. ``shuffle_partitions`` should follow the data volume (about
    128-256 MB of shuffle data per partition); AQE then coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to a session created elsewhere (e.g. the driver's)."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    # Python workers import this package by name, wherever the driver was started
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), ROOT]))


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


_LOCAL: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; it is shared by all executors, so
    lineage cuts survive the loss of one. Where it is unset, only a local run (one
    machine) gets a scratch folder of its own; a cluster job is refused.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="wardline-ckpt-")
        path = _LOCAL[context.applicationId]
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(path)
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A durable location for an intermediate table under the checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", name)


def together(spark: SparkSession, tasks: list[Callable], at_once: int = 4) -> list:
    """What independent tasks return, a few of them run at a time.

    The steps of one task that keep few cores busy leave the others to the jobs of its
    neighbours. All tasks end before the first error, in their order, is raised.
    """
    checkpoint_dir(spark)  # set once, not by whichever task is first
    with ThreadPoolExecutor(max(1, min(at_once, len(tasks)))) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    return [b.result() for b in begun]
