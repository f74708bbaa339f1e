"""Spark session helpers.

Library code never creates a session; jobs and tests do.  ``get_spark`` is the
one place the defaults live: AQE on, ANSI on (Spark 4 default), UTC session
time zone, UI off.  On a cluster the session already exists and carries its own
``spark.checkpoint.dir``; ``checkpoint_dir`` only fills it in when unset, as in
local tests.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "fetchplan", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect session
        pass
    if spark.conf.get("spark.checkpoint.dir", None) or (master or "").startswith("local"):
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder the cluster names.

    Uses the SparkContext's checkpoint folder, which Spark sets from
    ``spark.checkpoint.dir``.  Only when neither is set and the master is
    local a fresh scratch folder is created and given to the SparkContext; on a
    cluster that would be a folder of one machine, so it is an error there.
    The ``spark.checkpoint.dir`` setting itself cannot change at run time.  A
    remote (Spark Connect) session has no SparkContext here: its server's
    ``spark.checkpoint.dir`` applies and is returned as configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="fetchplan-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


MIB = 1024 * 1024


def size_shuffles(spark: SparkSession, shuffle_bytes: int, target_bytes: int = 256 * MIB,
                  min_partitions: int = 8, max_partitions: int = 100_000) -> int:
    """Size shuffles for an expected shuffle volume; returns the partition count.

    Sets the initial shuffle partition count so each reduce task gets about
    ``target_bytes`` (AQE then coalesces small partitions and splits skewed
    ones toward the same advisory size), and the scan split size to match.
    All four settings are runtime SQL settings.  Example: 100 TB of fact data
    whose heaviest shuffle moves 20 TB gives 81,920 partitions of 256 MiB.
    """
    parts = -(-int(shuffle_bytes) // int(target_bytes))
    parts = max(min_partitions, min(max_partitions, parts))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(target_bytes)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(int(min(2 * target_bytes, 1024 * MIB))))
    return parts
