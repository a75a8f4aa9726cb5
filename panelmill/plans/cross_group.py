"""Groups compared with each other from day to day.

Both views first aggregate to one row per (group, day). Their windows see only
that table: along one group, at most a row per calendar day; across one day, a
row per group, and groups are few because each is a storage partition. Means
are snapped to ten decimals before they are compared or ranked, so that the
order of summation decides neither a trend nor a tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.functions import change, pct_change, snap_round
from panelmill.operators.series import rolling
from panelmill.schemas import BARS, PanelSpec


def cross_sector_comparison(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Rounded group returns, 7 and 30 row averages, trend and money flow.

    The first day of a group is dropped before the volume lag is taken, so the
    second day has no money flow yet.
    """
    along = Window.partitionBy(spec.group).orderBy(spec.date)
    across = Window.partitionBy(spec.date)
    mean, prev = F.col("_close"), F.col("_prev_close")
    ma7, ma30 = F.col("_ma7"), F.col("_ma30")
    days = (
        bars.groupBy(spec.group, spec.date)
        .agg(F.avg(spec.close).alias("_close"), F.avg(spec.volume).alias("_volume"))
        .withColumns({
            "_prev_close": F.lag("_close").over(along),
            "_ma7": rolling("avg", "_close", 7, along),
            "_ma30": rolling("avg", "_close", 30, along),
        })
        .where(prev.isNotNull())
        .withColumn("_prev_volume", F.lag("_volume").over(along))
        .withColumn("_return", snap_round(change(mean, prev), 10))
        .withColumns({"_short": snap_round(ma7, 10), "_long": snap_round(ma30, 10)})
    )
    short, long = F.col("_short"), F.col("_long")
    return days.select(
        spec.group, spec.date,
        snap_round(mean, 2).alias("avg_close"),
        snap_round(F.col("_volume"), 0).alias("avg_volume"),
        snap_round(F.col("_return") * 100, 2).alias("sector_daily_return_pct"),
        snap_round(ma7, 2).alias("ma7"),
        snap_round(ma30, 2).alias("ma30"),
        F.when(short > long, "Bullish").when(short < long, "Bearish").otherwise("Neutral")
        .alias("trend"),
        snap_round(pct_change(F.col("_volume"), F.col("_prev_volume")), 2)
        .alias("money_flow_indicator"),
        F.rank().over(across.orderBy(F.desc_nulls_last("_return"))).cast("bigint")
        .alias("performance_rank"),
    )


def cross_sector_full(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """The unrounded comparison with price spread, volume change and money moved."""
    along = Window.partitionBy(spec.group).orderBy(spec.date)
    across = Window.partitionBy(spec.date)
    moved = change(F.col("avg_close"), F.col("prev_avg_close"))
    days = (
        bars.where(F.col(spec.group).isNotNull())
        .groupBy(spec.group, spec.date, "year", "month")
        .agg(
            F.count_distinct(spec.entity).alias("ticker_count"),
            F.avg(spec.close).alias("avg_close"),
            F.min(spec.close).alias("min_close"),
            F.max(spec.close).alias("max_close"),
            F.stddev_samp(spec.close).alias("price_volatility"),
            F.sum(spec.volume).cast("bigint").alias("total_volume"),
            F.avg(spec.volume).alias("avg_volume"),
        )
        .withColumns({
            "prev_avg_close": F.lag("avg_close").over(along),
            "_prev_volume": F.lag("total_volume").over(along),
            "ma7": rolling("avg", "avg_close", 7, along),
            "ma30": rolling("avg", "avg_close", 30, along),
        })
        .withColumn("_return", moved)
    )
    volume, before = F.col("total_volume").cast("double"), F.col("_prev_volume").cast("double")
    return days.select(
        spec.group, spec.date, "ticker_count",
        "avg_close", "min_close", "max_close", "price_volatility",
        "total_volume", "avg_volume", "prev_avg_close",
        (F.col("_return") * 100).alias("sector_daily_return_pct"),
        pct_change(volume, before).alias("volume_change_pct"),
        F.rank().over(across.orderBy(F.desc_nulls_last(snap_round(F.col("_return"), 10)))).cast("bigint")
        .alias("performance_rank"),
        (volume * F.col("_return")).alias("money_flow_indicator"),
        "ma7", "ma30", "year", "month",
    )
