"""Reading and writing whole tables, and replacing one as a whole.

A table is replaced in two steps: the new one is written to a folder beside it, and only when that is whole the
folders are swapped by renaming. So a table may be computed from itself, and a job that fails while it computes or writes
leaves the old table as it was. A swap that was broken off between its two renames is finished by ``settle_table``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_STAGED, _REPLACED = "-staged-", "-replaced-"


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A Parquet or CSV table, by the path's ending. CSV needs a schema or is read as text."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if path.rstrip("/").endswith(".csv"):
        return reader.csv(path, header=True)
    return reader.parquet(path)


def read_driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write, replacing what is there. Not meant for a path that ``df`` itself reads, see ``overwrite_table``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _store(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _siblings(spark: SparkSession, path: str, mark: str) -> list[str]:
    store, _ = _store(spark, path)
    found = store.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{mark}*"))
    return [f.getPath().toString() for f in found or []]


def _rename(spark: SparkSession, old: str, new: str) -> None:
    store, place = _store(spark, old)
    if not store.rename(place, _store(spark, new)[1]):
        raise OSError(f"{old} can't be renamed to {new}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, if it is there."""
    store, place = _store(spark, path)
    store.delete(place, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    store, place = _store(spark, path)
    return store.exists(place)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a whole folder in the place of another one, or where none is yet.

    Two renames in the store: cheap and all or nothing each in file systems. Object stores copy instead, so there the
    time between them is longer. Readers that listed the old files before the swap fail; they never mix old and new.
    """
    path = path.rstrip("/")
    old = f"{path}{_REPLACED}{uuid.uuid4().hex}"
    had = table_exists(spark, path)
    if had:
        _rename(spark, path, old)
    try:
        _rename(spark, staged, path)
    except Exception:
        if had:
            _rename(spark, old, path)
        raise
    if had:
        remove_folder(spark, old)
    spark.catalog.refreshByPath(path)


def overwrite_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace a Parquet table as a whole, also by a result computed from that table; gives the new table.

    One writer at a time. A frame that read the old table can't be computed any more afterwards.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    staged = f"{path}{_STAGED}{uuid.uuid4().hex}"
    try:
        write_table(df, staged, partition_by)
    except Exception:
        remove_folder(spark, staged)
        raise
    replace_folder(spark, staged, path)
    return read_table(spark, path)


def settle_table(spark: SparkSession, path: str) -> None:
    """Bring a table whose last writer was lost into order: the old table is back in place, unless the new one is.

    What the writer left beside it is removed. Not to be called while a writer is at work.
    """
    path = path.rstrip("/")
    replaced = _siblings(spark, path, _REPLACED)
    if replaced and not table_exists(spark, path):
        _rename(spark, replaced.pop(), path)
    for rest in [*replaced, *_siblings(spark, path, _STAGED)]:
        remove_folder(spark, rest)
