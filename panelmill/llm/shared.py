"""The shared folder: tables that cut lineage, and files that tasks write and read themselves."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session may go without the setting."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="panelmill-llm-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


ROW_GROUP_BYTES = 16 << 20
_made: list[str] = []


def folders_made() -> list[str]:
    """The folders of this session so far, in order."""
    return list(_made)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of ``new_folder`` that nothing will read again."""
    for path in folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _made.remove(path)


def new_folder(spark: SparkSession, what: str) -> str:
    """A folder of its own in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/panelmill-{what}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    system.deleteOnExit(target)
    _made.append(path)
    return path


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write the rows as Parquet in the shared folder once, and go on from the files.

    Small row groups: a writer holds one of them in memory, and whole texts are among what is stored.
    """
    path = f"{new_folder(df.sparkSession, what)}/rows"
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(path: str):
    """The pyarrow file system of a shared path, and the path within it; for use inside tasks."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as they need not have it installed."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if getattr(context, "_panelmill_shipped", False) or not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="panelmill-code-")) / "panelmill_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._panelmill_shipped = True


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)
