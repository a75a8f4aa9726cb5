"""Table schemas and the column roles of a panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RAW_BARS = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("fetched_at", T.TimestampType()),
])

MASTER = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# month and day are zero-padded text, also as partition values. fetched_at
# stays in the table because it decides which of two copies of a bar is newer.
PROCESSED_BARS = T.StructType([
    T.StructField("sector", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])


@dataclass(frozen=True)
class PanelSpec:
    """Which column plays which role, so that the operators fit any daily panel.

    A panel holds one row per (series, date). A series is one entity unless
    ``series`` names more columns, as when an entity reports to several groups.
    """

    entity: str = "ticker"
    group: str = "sector"
    date: str = "date"
    open: str = "open"
    high: str = "high"
    low: str = "low"
    close: str = "close"
    volume: str = "volume"
    series: tuple[str, ...] = ()

    @property
    def series_keys(self) -> list[str]:
        return list(self.series or (self.entity,))

    @property
    def row_keys(self) -> list[str]:
        return [*self.series_keys, self.date]

    @property
    def identity(self) -> list[str]:
        """The labels every per-entity output starts with."""
        return [self.entity, self.group, self.date]


BARS = PanelSpec()
