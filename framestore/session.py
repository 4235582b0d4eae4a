"""Session helpers: time zone rule, shared scratch folder, plan size."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from framestore.errors import InvalidInputError

_UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def require_utc(spark: SparkSession) -> None:
    """Wall clock arithmetic is only exact when the session zone has no shifts."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC_NAMES:
        raise InvalidInputError(
            f"Set spark.sql.session.timeZone to UTC for datetime conversion, it is {zone!r}", data=zone
        )


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: what the cluster names in spark.checkpoint.dir.

    Where that is unset, a folder in the warehouse, which all executors reach as well. On a cluster
    a warehouse on a local disk is none of these, so that fails early.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    is_local = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    if is_local and not spark.sparkContext.master.startswith("local"):
        raise InvalidInputError("Set spark.checkpoint.dir to a folder that all executors share", data=warehouse)
    return f"{warehouse}/framestore-scratch"


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the reader
    measured sizes and row group statistics. Returns the frame and its path.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/framestore/{label}-{uuid.uuid4().hex}"
    note_staged(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


_NOTED: list[list[str]] = []


def note_staged(path: str) -> None:
    """Tell every `staged_paths` that is open of a table in the shared folder."""
    for paths in _NOTED:
        paths.append(path)


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """The paths of the tables that are staged inside. Who has read all that was made of them may delete them."""
    paths: list[str] = []
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        _NOTED[:] = [x for x in _NOTED if x is not paths]


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[list[str]]:
    """The tables that are staged inside are deleted at the end, but for those whose paths are put into the list."""
    kept: list[str] = []
    with staged_paths() as paths:
        try:
            yield kept
        finally:
            for path in paths:
                if path not in kept:
                    delete_path(spark, path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a statement that runs inside are deleted when it ends.

    Otherwise they stay until the driver's garbage collector finds them, which a larger input does not hasten.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this package wrote, through the Hadoop file system API."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(hadoop_path, True))


_SCRATCH: dict[str, list[str]] = {}


def own_scratch(spark: SparkSession, path: str) -> None:
    """Note a staged table that frames still read, for `delete_scratch`."""
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)


def delete_scratch(spark: SparkSession) -> None:
    """Delete the staged tables of chunks and positions of this application. Their frames cannot be read afterwards."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of `df` (file sizes for a scan; huge when unknown)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """True if Catalyst's own size check would let it broadcast `df`.

    Used to pick the plan shape only. No join is ever hinted: Spark applies the
    same limit again, with run time sizes, before it broadcasts.
    """
    return plan_bytes(df) <= broadcast_limit(df.sparkSession)
