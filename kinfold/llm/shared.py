"""Folders and files that driver and executors both reach."""

from __future__ import annotations

import ctypes
import uuid
from functools import wraps

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from kinfold.session import cut_lineage, shared_dir

__all__ = ["batches_of_bytes", "cut_lineage", "documents", "frugal", "give_back", "new_folder", "open_folder", "publish", "table"]

BATCH_BYTES, BATCH_ROWS = 8 << 20, 512


def batches_of_bytes(spark: SparkSession) -> SparkSession:
    """Let Arrow batches end at a few hundred rows or megabytes, so that Python workers and Arrow buffers stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark



def give_back() -> None:
    """Hand memory that a worker has freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not that C library
        pass


def frugal(keeps_cache: bool):
    """For task functions: a worker lives on for other tasks and operators, so what it doesn't need goes back at the end.

    Without ``keeps_cache`` the answers that another operator has cached in this worker go first.
    """
    def decorate(function):
        @wraps(function)
        def run(batches, *arguments):
            from kinfold.llm.tokens import Cache

            if not keeps_cache and Cache.last is not None:
                Cache.last.empty()
            yield from function(batches, *arguments)
            give_back()
        return run
    return decorate


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh folder name below the shared one, as a URI."""
    base = shared_dir(spark)
    return f"{base if '://' in base else 'file://' + base}/{prefix}-{uuid.uuid4().hex}"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; works in tasks, for every store that Arrow knows."""
    files, path = pafs.FileSystem.from_uri(uri)
    files.create_dir(path, recursive=True)
    return files, path


def publish(files: pafs.FileSystem, path: str, name: str, attempt: str, data) -> None:
    """Write a file under a name of this attempt, then move it in place: readers never see half a file.

    A task that runs again writes the same bytes, so it does not matter which attempt comes last.
    """
    draft = f"{path}/_{attempt}-{name}"
    with files.open_output_stream(draft, compression=None) as out:
        for block in data:
            out.write(block)
    files.move(draft, f"{path}/{name}")
