"""Session construction and the shared folders that checkpoints and artifacts go to."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "palate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here relies on (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # a task has one core: matrix products must not start a thread per core each
        "spark.executorEnv.OMP_NUM_THREADS": "1",
        "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
        **conf,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a fresh local one in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and context.getCheckpointDir() is not None:
        configured = context.getCheckpointDir()
    if configured is None:
        # one process only: local, local[4], local[4,2], not local-cluster[...]
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="palate-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/palate-{label}-{uuid.uuid4().hex}"


def keep_table(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: later reads prune columns and push filters down."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor and keeps iterative plans short."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def freeing_shuffles(spark: SparkSession, seconds: float = 20.0) -> Iterator[None]:
    """While the body runs, the driver collects garbage now and then.

    Spark removes the shuffle files of an RDD that nothing refers to when the driver collects garbage, and asks for that every 30
    minutes. A fit that writes gigabytes per iteration fills the disks before.
    """
    done = threading.Event()
    system = spark.sparkContext._jvm.System

    def collect() -> None:
        while not done.wait(seconds):
            system.gc()

    thread = threading.Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
