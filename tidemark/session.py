"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession


# The zone makes TIMESTAMP_NTZ arithmetic exact.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and a UTC zone.

    ``TIMESTAMP_NTZ`` arithmetic goes through epoch micros, which is only zone-free
    when the session zone is UTC.  The master is left to the deployment unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **REQUIRED,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session somebody else created."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset, a fresh folder
    below the warehouse (which driver and executors share) is chosen, remembered on the
    session and deleted when the program ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidemark-{uuid.uuid4().hex[:12]}"
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(_remove, spark, folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of our own through Spark's file system, if the session is still there."""
    with contextlib.suppress(Exception):  # the session may have ended before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh sub-folder path below :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: used where one expensive result feeds several jobs."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
