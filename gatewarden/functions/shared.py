"""Results that several parts of a job read, computed once and kept as a table."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}
_one_folder = Lock()
_job: ContextVar[tuple[str, ...]] = ContextVar("job", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors reach.

    Only a local session without that setting gets a temporary folder, removed
    when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = context.applicationId
    with _one_folder:
        if application not in _local_folders:
            _local_folders[application] = tempfile.TemporaryDirectory(prefix="gatewarden-")
    return _local_folders[application].name


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/gatewarden/{spark.sparkContext.applicationId}"


def results_folder(spark: SparkSession) -> str:
    """The subfolder of this application's shared results, and within a job of that job's."""
    return "/".join([_application_folder(spark), *_job.get()])


def remove_shared_results(spark: SparkSession) -> bool:
    """Delete all shared results of this application; True if there were any.

    Call it when no result that was built from them is needed any more: they
    are read lazily. Other applications' folders are not touched.
    """
    return _removed(spark, _application_folder(spark))


def _removed(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


@contextmanager
def job_results(spark: SparkSession) -> Iterator[str]:
    """Remove what is computed once within the block as soon as it ends, also by an error.

    For services that run jobs again and again: build a job and write its output inside.
    A frame built inside cannot be read outside. Blocks may be nested, and
    threads do not share them, but for those of ``side_by_side``.
    """
    token = _job.set((*_job.get(), f"job-{uuid.uuid4().hex}"))
    folder = results_folder(spark)
    try:
        yield folder
    finally:
        _job.reset(token)
        _removed(spark, folder)


def computed_once(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Later parts then scan only the columns they need of a small columnar
    table, a lost executor costs no recomputation of the events, and Spark
    plans with the table's true size. All tables of an application lie in one
    subfolder, which ``remove_shared_results`` removes when its jobs are done.
    """
    spark = frame.sparkSession
    path = f"{results_folder(spark)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def side_by_side[T](*steps: Callable[[], T]) -> list[T]:
    """The results of steps that do not need each other, whose Spark jobs may run at one time.

    A job of few tasks then does not leave the other cores idle. The steps belong to the caller's job.
    """
    with ThreadPoolExecutor(len(steps)) as threads:
        return [done.result() for done in [threads.submit(copy_context().run, step) for step in steps]]
