"""Raw CSV bars, as a batch or as a stream of new files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.schemas import RAW_BARS

SOURCE_PATH = "_source_path"
REJECTED = "_rejected_line"
_WITH_LINE = T.StructType([*RAW_BARS, T.StructField(REJECTED, T.StringType())])

# The schema is given, so no pass over the files is spent on inferring it; the
# headers are still checked against it. Folders may nest to any depth, and
# their names are ignored: every value comes from the file's columns.
_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "dateFormat": "yyyy-MM-dd",
    "recursiveFileLookup": True,
    "pathGlobFilter": "*.csv",
    "columnNameOfCorruptRecord": REJECTED,
}


def _with_path(df: DataFrame) -> DataFrame:
    # the scan tells names as in a URL, where a plus stands for itself
    name = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return df.withColumn(SOURCE_PATH, F.url_decode(name))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their file's name, and in ``_rejected_line`` the text of lines that do not parse."""
    return _with_path(spark.read.schema(_WITH_LINE).options(**_OPTIONS).csv(path))


def _all_read() -> Column:
    """True, and makes the scan read every column: a column that is not read cannot reject its line."""
    return F.xxhash64(*RAW_BARS.names) >= F.lit(-(2**63))


def accepted(lines: DataFrame) -> DataFrame:
    """The rows that parse in all columns."""
    return lines.where(F.col(REJECTED).isNull() & _all_read()).drop(REJECTED)


def rejected(lines: DataFrame) -> DataFrame:
    """The lines that do not: ticker if readable, file and text."""
    bad = lines.where(F.col(REJECTED).isNotNull() & _all_read())
    return bad.select("ticker", F.col(SOURCE_PATH).alias("source_file"), F.col(REJECTED).alias("line"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files below a folder, or one file, with the name of the file each row came from.

    Lines with a value that does not fit its column are left out; ``rejected`` has them.
    """
    return accepted(read_lines(spark, path))


def stream_raw(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """The lines as a stream, rejected ones included: each new file once.

    ``max_files`` bounds a micro-batch, to load a large backlog in steps.
    """
    reader = spark.readStream.schema(_WITH_LINE).options(**_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_path(reader.csv(root))
