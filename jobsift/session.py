"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "jobsift", master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session with runtime re-planning on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints and hand-over tables.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  A temporary
    folder is used only where that is unset and the session is local, which is
    the case in tests; on a cluster executors would not share it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
        return shared
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^,\]]*(,\s*\d+)?\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="jobsift-"))
    return context.getCheckpointDir()


_scratch: ContextVar[str | None] = ContextVar("jobsift_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, or under the work folder of a stage."""
    folder = _scratch.get() or f"{checkpoint_dir(spark).rstrip('/')}/jobsift"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The store of a path, as Spark sees it, and the path in it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


@contextmanager
def scratch_folder(spark: SparkSession, folder: str) -> Iterator[None]:
    """Hand-over tables lie in ``folder`` meanwhile; it is removed before and after.

    What is read from them must have been used up, or written elsewhere, by the end.
    """
    fs, path = file_system(spark, folder)
    fs.delete(path, True)
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        fs.delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let Spark drop the shuffle files of each write at its end.

    For plans that never run again since a written table takes their place; else
    the files wait for the driver's garbage collection.
    """
    conf = spark.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


# Tables that hold whole texts and are read once or twice are written in the denser codec.
CODECS = {"texts": "zstd"}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, so work done before an executor is lost is not done again.
    The shuffle files of the write go at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", CODECS[name]) if name in CODECS else df.write
    with shuffles_dropped(spark):
        writer.parquet(path)
    return spark.read.parquet(path)


# Bytes of a batch that goes to a Python worker: both sides hold it, whatever the length of its texts.
ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BATCH_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    Batches for the workers are bounded by bytes, unless the application has a bound of its own;
    by rows alone, one of long texts takes any size.
    """
    context = spark.sparkContext
    if not context.getConf().contains(ARROW_BATCH):
        spark.conf.set(ARROW_BATCH, str(ARROW_BATCH_BYTES))
    if getattr(context, "_jobsift_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="jobsift-"), "jobsift"),
        "zip",
        root_dir=os.path.dirname(package),
        base_dir=os.path.basename(package),
    )
    context.addPyFile(archive)
    context._jobsift_shipped = True
