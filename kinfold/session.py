"""Session settings the library's plans count on."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# All of these are runtime SQL settings, so they can be applied to a session
# somebody else built. They are only the switches that the plans rely on; sizes
# (shuffle partitions, split bytes, memory) stay with the cluster.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys are split by AQE on joins; see operators/merge.py.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Filters reach the reader of survey files; see sources/dta.py.
    "spark.sql.python.filterPushdown.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the plan settings to an existing session."""
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kinfold", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without one gets a fresh folder of its own; a cluster session
    without one is an error, because a machine-local folder would lose data
    together with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="kinfold-")
    spark.sparkContext.setCheckpointDir(own)
    return own


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def own_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh path below the shared folder, removed at the end of ``written_tables`` as the written tables are."""
    path = f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"
    if _written.get() is not None:
        _written.get().append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Later uses read only the columns they need, and nothing upstream is computed
    again when an executor is lost. The table stays until the folder is cleaned, or
    until ``written_tables`` ends.
    """
    spark = df.sparkSession
    path = own_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Steps:
    """Written tables of a long job, each of which may take the place of earlier ones.

    A single job keeps the shuffle files of all its merges until it ends. Written step by step, disk holds those of one merge at
    a time (inside ``freed_shuffles``), besides the tables still needed. For frames that are wanted with all their columns:
    columns that nobody reads later are computed and written all the same.
    """

    def __init__(self) -> None:
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def cut(self, df: DataFrame, *replaced: DataFrame) -> DataFrame:
        """``cut_lineage``; earlier steps in ``replaced`` are removed then, nothing may read them any more."""
        spark = df.sparkSession
        path = own_folder(spark, "table")
        df.write.parquet(path)
        for old in replaced:
            _remove(spark, self._paths.pop(id(old))[1])
        out = spark.read.parquet(path)
        self._paths[id(out)] = out, path
        return out


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of each action inside are removed when it ends, not when the driver happens to collect its garbage.

    Frames that are run several times write their shuffles again each time.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def written_tables(spark: SparkSession):
    """Tables and folders that are written inside (``cut_lineage``, ``own_folder``) are removed at the end, also after an error.

    Results that read them have to be written or collected before that.
    """
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            _remove(spark, path)
