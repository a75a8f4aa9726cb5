"""Intermediate results that outlive the executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="panelmill-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def file_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark can reach."""
    system, target = _file_system(spark, path)
    return system.exists(target)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder."""
    system, target = _file_system(spark, path)
    return system.getContentSummary(target).getLength()


def leave_mark(spark: SparkSession, path: str) -> None:
    """Create an empty file, to be found by a later run."""
    system, target = _file_system(spark, path)
    system.create(target, True).close()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder, sorted."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory())


def partition_folders(spark: SparkSession, path: str, depth: int) -> set[str]:
    """Relative paths of the partition folders so many levels below a table's folder."""
    found = {""}
    for _ in range(depth):
        found = {
            f"{parent}/{name}" for parent in found
            for name in subfolders(spark, f"{path.rstrip('/')}{parent}") if "=" in name
        }
    return {f.lstrip("/") for f in found}


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that this package wrote itself."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in a folder; none if there is no such folder."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return [s.getPath().getName() for s in system.listStatus(target) if s.isFile()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file."""
    system, target = _file_system(spark, path)
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    system, target = _file_system(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move_into_place(spark: SparkSession, aside: str, path: str) -> None:
    """Rename a finished file to a name that must be free."""
    system, source = _file_system(spark, aside)
    _, target = _file_system(spark, path)
    if system.exists(target) or not system.rename(source, target):
        raise FileExistsError(f"{path} exists: another run was faster")
