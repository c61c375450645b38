"""Session settings and the shared folder for checkpoints and working tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skybasin")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    without it is refused, since a folder on one machine would be lost with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="skybasin-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession) -> str:
    """The folder of this application below the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/skybasin-{spark.sparkContext.applicationId}"
    context = spark.sparkContext
    for name in (path, context.getCheckpointDir()):
        folder = context._jvm.org.apache.hadoop.fs.Path(name)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return path


def working_dir(spark: SparkSession, purpose: str) -> str:
    """A name for a fresh folder of its own below that of the application."""
    return f"{run_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, jobs: list[Callable]) -> list:
    """Run jobs that write different tables at once: one fills the gaps another leaves."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]
