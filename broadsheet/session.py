"""Session helpers: configuration, shared scratch folder, lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts travel to Python in small batches, so memory does not follow their length.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def build_session(app: str = "broadsheet", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster the master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on (UTC clock, dynamic overwrite)."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and everything
    runs in one process (local tests) a private folder is made and set; elsewhere executors
    could not see it, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.mkdtemp(prefix="run-"), "checkpoints")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_run: ContextVar[str] = ContextVar("run", default="")


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Intermediates written inside belong to this run and are removed at its end.

    For jobs that commit their outputs inside, such as a micro-batch; a frame that is returned lazily
    must not read intermediates of a finished run. The folder goes through Spark's file system, so any store works.
    """
    folder = f"run-{uuid.uuid4().hex}"
    token = _run.set(f"{folder}/")
    try:
        yield
    finally:
        _run.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/broadsheet/{folder}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for written intermediates."""
    return f"{shared_root(spark)}/broadsheet/{_run.get()}{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` in the shared folder and read it back.

    A written table survives the loss of any executor, keeps column statistics for later
    stages and drops the lineage, which iterative jobs need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime settings that hold inside only."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: For jobs whose steps are all written tables: these small, and shuffle files gone with the step that made them (else they stay until the
#: driver happens to collect its garbage). A plan that runs twice would make its shuffles anew.
LEAN_CONF = {"spark.sql.parquet.compression.codec": "zstd", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
