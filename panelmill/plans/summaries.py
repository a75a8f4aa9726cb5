"""Plain aggregates per group and day, entity and month, or group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.functions import month_start, snap_round
from panelmill.schemas import BARS, PanelSpec


def sector_daily_summary(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Row count, mean close and volume, lowest low and highest high per group and day."""
    return bars.groupBy(spec.group, spec.date).agg(
        F.count(F.lit(1)).alias("ticker_count"),
        snap_round(F.avg(spec.close), 2).alias("avg_close"),
        snap_round(F.avg(spec.volume), 0).alias("avg_volume"),
        snap_round(F.min(spec.low), 2).alias("sector_min"),
        snap_round(F.max(spec.high), 2).alias("sector_max"),
    )


def ticker_monthly_summary(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Mean close, extremes, volume and trading days per entity and calendar month."""
    return bars.groupBy(spec.entity, spec.group, month_start(spec.date).alias("month")).agg(
        snap_round(F.avg(spec.close), 2).alias("monthly_avg_close"),
        snap_round(F.max(spec.high), 2).alias("monthly_high"),
        snap_round(F.min(spec.low), 2).alias("monthly_low"),
        F.sum(spec.volume).cast("bigint").alias("total_volume"),
        F.count(F.lit(1)).alias("trading_days"),
    )


def named_sector_daily(
    bars: DataFrame, year: int, month: str, spec: PanelSpec = BARS
) -> DataFrame:
    """Group figures for the days of one month; unrounded."""
    chosen = bars.where((F.col("year") == year) & (F.col("month") == month))
    return chosen.groupBy(spec.group, spec.date).agg(
        F.count_distinct(spec.entity).alias("num_stocks"),
        F.avg(spec.close).alias("avg_close_price"),
        F.sum(spec.volume).cast("bigint").alias("total_volume"),
        F.min(spec.low).alias("sector_min_price"),
        F.max(spec.high).alias("sector_max_price"),
        F.stddev_samp(spec.close).alias("price_volatility"),
    )


def named_sector_comparison(bars: DataFrame, year: int, spec: PanelSpec = BARS) -> DataFrame:
    """Group figures over one year; unrounded."""
    return bars.where(F.col("year") == year).groupBy(spec.group).agg(
        F.count_distinct(spec.entity).alias("num_companies"),
        F.avg(spec.close).alias("avg_price"),
        F.avg(spec.volume).alias("avg_volume"),
        F.sum(spec.volume).cast("bigint").alias("total_volume"),
        F.min(spec.date).alias("data_start_date"),
        F.max(spec.date).alias("data_end_date"),
        F.count(F.lit(1)).alias("total_records"),
    )
