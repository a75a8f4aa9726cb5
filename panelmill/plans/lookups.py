"""Row views over processed bars and lookups in curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.schemas import BARS, PanelSpec

_PRICES = ["open", "high", "low", "close", "volume"]


def enriched_view(bars: DataFrame, since_year: int) -> DataFrame:
    """Bars since a year with their lineage; prunes to the year partitions."""
    return bars.where(F.col("year") >= since_year).select(
        "ticker", "date", "year", "month", "day", *_PRICES, "ingested_at", "source_file"
    )


def sector_view(
    bars: DataFrame, sector: str, since_year: int, ticker: str | None = None
) -> DataFrame:
    """Bars of one sector since a year, or of one of its tickers."""
    chosen = bars.where((F.col("sector") == sector) & (F.col("year") >= since_year))
    if ticker is not None:
        chosen = chosen.where(F.col("ticker") == ticker)
    return chosen.select(
        "sector", "ticker", "date", "year", "month", "day", *_PRICES, "exchange", "country"
    )


def latest_day(table: DataFrame, spec: PanelSpec = BARS, newest: DataFrame | None = None) -> DataFrame:
    """The rows of the table's newest date.

    ``newest`` is one row with that date, for a table that costs more to build
    than its dates are to find.
    """
    newest = table.agg(F.max(spec.date)) if newest is None else newest
    return table.where(F.col(spec.date) == newest.scalar())


def newest_move(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """The newest date on which a bar has one before it, without any window."""
    ends = bars.groupBy(*spec.series_keys).agg(F.min(spec.date).alias("first"), F.max(spec.date).alias("last"))
    return ends.where("first < last").agg(F.max("last"))


def latest_rows(table: DataFrame, n: int = 10, spec: PanelSpec = BARS) -> DataFrame:
    """First ``n`` rows by newest date; the group decides ties."""
    return table.orderBy(F.desc(spec.date), F.asc(spec.group)).limit(n)


def of_risk(volatility: DataFrame, category: str) -> DataFrame:
    """All rows of one risk class."""
    return volatility.where(F.col("risk_category") == category)


def top_sectors(comparison: DataFrame, n: int = 10, spec: PanelSpec = BARS) -> DataFrame:
    """First ``n`` rows by newest date and rank; the group decides ties."""
    return comparison.orderBy(
        F.desc(spec.date), F.asc("performance_rank"), F.asc(spec.group)
    ).limit(n)


def highest_risk(
    volatility: DataFrame, category: str, n: int = 10, spec: PanelSpec = BARS
) -> DataFrame:
    """Newest ``n`` rows of one risk class; the entity decides ties."""
    return (
        of_risk(volatility, category)
        .orderBy(F.desc(spec.date), F.asc(spec.entity))
        .limit(n)
    )
