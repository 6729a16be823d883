"""SparkSession construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import SparkSession

# Settings that hold at any scale: AQE re-plans joins and partition counts
# from measured shuffle sizes, splits skewed join partitions, and broadcasts
# only a side measured under the threshold at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    # Capturing a Python call site for every Column costs several py4j round
    # trips per expression; production jobs do not need it (static setting).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "ledgerlake",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's defaults; ``conf`` overrides any of them.

    On a cluster, leave ``master`` to spark-submit and size
    ``spark.sql.shuffle.partitions`` to the input (AQE coalesces downwards).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system location and is
    used as is. Only when it is unset and the master is ``local`` (tests) is a
    local folder created and registered; elsewhere an unset one is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, use the setting as is
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured.rstrip("/")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_root(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/ledgerlake-{label}-{uuid.uuid4().hex[:12]}"


def side_by_side(jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """The results of jobs that need nothing of each other, submitted to Spark together.

    The last tasks of one leave cores idle that the others can use. All have ended when
    this returns; the first failure, in the order of ``jobs``, is raised then.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: done.result() for name, done in running.items()}
