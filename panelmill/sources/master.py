"""Where the master table comes from."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelmill.operators.enrich import current_labels
from panelmill.schemas import MASTER

LABELS = ["ticker", "sector", "exchange", "country"]


@dataclass(frozen=True)
class JdbcMaster:
    """A table in a SQL database; ``options`` may split the read into ranges."""

    url: str
    table: str = "stocks"
    properties: dict[str, str] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)

    def load(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format("jdbc").options(
            url=self.url, dbtable=self.table, **self.properties, **self.options
        )
        return reader.load()


@dataclass(frozen=True)
class SnapshotMaster:
    """A folder with an exported key-value table; all its files are one table."""

    path: str
    format: str = "json"

    def load(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MASTER).format(self.format).load(self.path)


@dataclass(frozen=True)
class SeedMaster:
    """One JSON file with an array of rows."""

    path: str

    def load(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MASTER).option("multiLine", True).json(self.path)


@dataclass(frozen=True)
class HistoryMaster:
    """A folder with a row for each change of a ticker's labels and the date ``valid_from`` which it holds."""

    path: str
    format: str = "json"

    def load(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([*MASTER, T.StructField("valid_from", T.DateType())])
        return spark.read.schema(schema).format(self.format).load(self.path)


MasterSource = JdbcMaster | SnapshotMaster | SeedMaster | HistoryMaster


def read_master(
    spark: SparkSession,
    source: MasterSource | DataFrame | None,
    columns: list[str] | None = None,
    required: bool = False,
) -> DataFrame:
    """The master's key and labels.

    No source, or one that cannot be opened, gives an empty table: bars then
    get the unknown group. ``required`` raises instead. Of several rows of a ticker
    the latest is taken, so that a repeated export multiplies nothing.
    """
    wanted = columns or LABELS
    empty = spark.createDataFrame([], MASTER).select(*wanted)
    if source is None:
        return empty
    if isinstance(source, DataFrame):
        return _chosen(source, columns)
    try:
        return _chosen(source.load(spark), columns)
    except Exception as error:
        if required or not isinstance(error, _unavailable()):
            raise
        warnings.warn(f"no master data, going on without: {error}", stacklevel=2)
        return empty


def _chosen(master: DataFrame, columns: list[str] | None) -> DataFrame:
    """The named columns, or a row of labels per ticker (and ``valid_from``): the latest of several."""
    if columns is not None:
        return master.select(*columns)
    return current_labels(master).select(*LABELS, *[c for c in ("valid_from",) if c in master.columns])


def _unavailable() -> tuple[type[Exception], ...]:
    """Spark's own errors and those of a database driver."""
    from py4j.protocol import Py4JJavaError

    return (PySparkException, Py4JJavaError)
