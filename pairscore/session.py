"""Session settings and the shared work folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "pairscore", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution; cluster sizing comes from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # long texts: bound what one Arrow batch holds
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}
# the folder of the job that runs in an application, while one does
_job_folders: dict[str, str] = {}


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Everything stored inside the block goes into one folder, which is removed at its end, after an error too.

    What is to be kept has to be written elsewhere by then. One job of an application at a time:
    a block inside another one belongs to the outer one.
    """
    app = spark.sparkContext.applicationId
    if app in _job_folders:
        yield _job_folders[app]
        return
    folder = _job_folders[app] = work_folder(spark, "job")
    try:
        yield folder
    finally:
        del _job_folders[app]
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach; a job's are below its own.

    Only a local session may run without that setting; it then gets a temporary
    folder for the rest of the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = context.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="run-")
        base = _local_folders[app]
    base = _job_folders.get(spark.sparkContext.applicationId, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the work folder and read it back.

    Unlike a cache, the written table outlives lost executors, and everything
    expensive above it (model inference, wide joins) is not run again.
    """
    path = work_folder(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is built and run inside the block go when it has run, not when the driver collects garbage.

    For jobs repeated many times over, each of which is read once.
    """
    before = spark.conf.get(REMOVE_SHUFFLES)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


FILE_COST, TASK_BYTES = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"


@contextmanager
def task_per_file(spark: SparkSession) -> Iterator[None]:
    """What is run inside the block reads each file by a task of its own (larger ones by several).

    For files that take long for their bytes: a few would else share a task while cores wait."""
    before = spark.conf.get(FILE_COST)
    spark.conf.set(FILE_COST, spark.conf.get(TASK_BYTES))
    try:
        yield
    finally:
        spark.conf.set(FILE_COST, before)


_shipped: set[tuple[str, str]] = set()


def ship_package(spark: SparkSession, root: str, package: str) -> None:
    """Send the package below ``root`` to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if (app, package) not in _shipped:
        folder = tempfile.mkdtemp(prefix="pairscore-code-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package}", "zip", root, package))
        _shipped.add((app, package))
