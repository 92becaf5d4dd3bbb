"""Tables that a job writes once and reads several times."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
_local_folder: tempfile.TemporaryDirectory | None = None
_shared: set[tuple[str, str]] = set()
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _on_file_system(spark: SparkSession, folder: str) -> str:
    """A folder with its file system; one given as a plain path lies in the cluster's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


def _require_shared(spark: SparkSession, folder: str) -> None:
    """Raise if tasks write to disks of their own, so that a part of what they write is missing."""
    probe = f"{folder}/tallymark-probe-{uuid.uuid4().hex}"
    parts = 2 * spark.sparkContext.defaultParallelism
    try:
        spark.range(0, parts, 1, parts).write.parquet(probe)
        seen = spark.read.schema("id long").parquet(probe).count()
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(probe)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if seen != parts:
        raise ValueError(f"set {FOLDER_SETTING} to a folder shared by all executors; they do not share {folder}")


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see, as named by the cluster.

    Without the setting a local session gets a temporary folder.  On a cluster the context's
    checkpoint folder takes its place, or else the warehouse.  A place there on a plain
    local path or `file:` may be a disk of each machine, so a few small files are written
    first; only a setting that itself says `file:` is taken at its word.
    """
    folder = spark.conf.get(FOLDER_SETTING, None)
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    if folder and (local or "://" in folder or folder.startswith("file:")):
        return folder.rstrip("/")
    if local:
        global _local_folder
        if _local_folder is None:
            _local_folder = tempfile.TemporaryDirectory(prefix="tallymark-")
        return _local_folder.name
    found = folder or spark.sparkContext.getCheckpointDir() or spark.conf.get(WAREHOUSE_SETTING)
    place = _on_file_system(spark, found).rstrip("/")
    known = (spark.sparkContext.applicationId, place)
    if place.startswith("file:") and known not in _shared:
        _require_shared(spark, place)
        _shared.add(known)
    return place


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tallymark-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, keeps column pruning for the passes that follow, and survives
    the loss of executors.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    staged = spark.read.schema(df.schema).parquet(folder)
    _folders[staged] = folder
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete tables that `stage` returned, once nothing that is still to be computed reads them."""
    for frame in staged:
        folder = _folders.pop(frame, None)
        if folder:
            spark = frame.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
