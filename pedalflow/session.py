"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


_removed_at_exit: set[str] = set()


def get_spark(app_name: str = "pedalflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; on a cluster pass no master."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The application's folder under ``spark.checkpoint.dir``, removed when the application ends.

    A local session without that setting gets a temporary folder; a cluster without it is an
    error, because executors on other machines could not read what one of them writes.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            folder = tempfile.mkdtemp(prefix="pedalflow-")
        context.setCheckpointDir(folder)
    own = context.getCheckpointDir()  # Spark makes a new one in the folder for each application
    if own not in _removed_at_exit:
        _removed_at_exit.add(own)
        _remove_at_exit(spark, own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, so a lost executor costs no replay."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def planning_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of its own with the settings of ``spark``, but without adaptive execution, for loops that lay out
    their data themselves. A checkpoint made there keeps its partitioning and order, so later joins find it in place.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.adaptive.enabled", "false")
    other.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return other


def in_session(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back by another session."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_at_exit(spark: SparkSession, table: str) -> None:
    """Drop a table that only this application uses when it ends."""
    _at_exit(lambda: spark.sql(f"DROP TABLE IF EXISTS {table}"))


def _at_exit(action: Callable[[], object]) -> None:
    def run() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            action()

    atexit.register(run)


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Remove the application's folder of checkpoints and scratch tables when it ends."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    _at_exit(lambda: path.getFileSystem(conf).delete(path, True))
