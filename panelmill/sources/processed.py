"""Processed bars as stored."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.operators.rows import dedupe_bars
from panelmill.schemas import PROCESSED_BARS


def in_months(stored: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Stored bars of some months; the scan is pruned to their folders."""
    months = list(months)
    dated = [f"{y}{m:02d}" for y, m in months if y]
    wanted = F.concat(F.col("year").cast("string"), F.col("month")).isin(dated) if dated else F.lit(False)
    return stored.where(wanted | F.col("year").isNull() if (0, 0) in months else wanted)


def read_bars(
    spark: SparkSession, path: str, unique: bool = True, months: Iterable[tuple[int, int]] | None = None
) -> DataFrame:
    """Stored bars with padded month and day, whatever the folder layout.

    Appending the same file twice, or a bar whose group changed since, leaves
    two rows for one day. ``unique`` keeps the latest; turn it off for tables
    that are only ever written in replace mode with stable groups. ``months``
    reads the folders of some months only; (0, 0) is that of rows without a date.
    """
    stored = spark.read.schema(PROCESSED_BARS).parquet(path)
    if months is not None:
        stored = in_months(stored, months)
    bars = stored.select(*[F.col(f.name) for f in PROCESSED_BARS])
    return dedupe_bars(bars) if unique else bars
