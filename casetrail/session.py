"""Session settings every job in the library relies on.

The models pin the session time zone to UTC (``::date`` and week truncation
depend on it), keep AQE on so small shuffles coalesce and skewed join
partitions are split at run time, and need a *shared* checkpoint folder for
lineage cuts.  ``spark.checkpoint.dir`` is read from the session; a local
scratch folder is only set when the setting is absent (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks that event feeds are spread over before they are parsed (default: those of a shuffle).
EVENT_TASKS = "spark.casetrail.eventTasks"

# Settings applied to whatever session a caller hands us.  All are runtime
# SQL confs, so they can be set on an existing session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split a partition that holds far more than its peers.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


#: Spark's switch for dropping the shuffle files of a query as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, every query drops its shuffle files when it ends, instead of when the driver
    happens to collect its garbage; for chains of writes whose results are read from tables."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def spread(events: DataFrame) -> DataFrame:
    """Event rows dealt to many tasks by their hash, however few tasks can read their files."""
    conf = events.sparkSession.conf
    tasks = conf.get(EVENT_TASKS, None) or conf.get("spark.sql.shuffle.partitions")
    return events.repartition(int(tasks), F.xxhash64(*[F.col(f"`{c}`") for c in events.columns]))


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, creating a local one if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is used as is; without it this raises.  Only in local mode (unit tests, a laptop)
    do we fall back to a fresh local scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no driver-side context (e.g. Spark Connect)
        sc = None
    if sc is not None and not current:
        current = sc.getCheckpointDir()
    if current:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not spark.conf.get("spark.master", "local").startswith("local") or (
            spark.conf.get("spark.master", "").startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="casetrail-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "casetrail") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CASETRAIL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if str(cores).isdigit():
        builder = builder.config(EVENT_TASKS, str(cores))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
