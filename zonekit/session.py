"""Session set-up (S11) and reuse of computed frames.

The library never owns the cluster: every function takes the caller's
``SparkSession``.  ``get_session`` is only a convenience default for
scripts and tests.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins
# and coalesces/splits partitions from runtime statistics, the UI server
# stays off, and calendar dates are computed in a pinned time zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "zonekit",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session or build one with sensible defaults.

    ``master`` is only applied when given (``local[n]`` in tests and the
    bench); on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is ``default`` installed.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if default is None:
        return None
    spark.conf.set("spark.checkpoint.dir", default)
    return default


def reuse(df: DataFrame, cut_lineage: bool = False) -> DataFrame:
    """Keep a frame that several KPIs read.

    ``persist(MEMORY_AND_DISK)`` by default: a lost executor only means
    the lost blocks are recomputed from lineage.  With ``cut_lineage`` the
    frame is checkpointed into ``spark.checkpoint.dir`` (reliable storage),
    which must then be set; a machine-local folder is never used.
    """
    if not cut_lineage:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if not folder:
        raise ValueError("cut_lineage=True needs spark.checkpoint.dir to be set")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
