"""Daily returns and the standing of each entity inside its group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.functions import change, pct_change, ratio, snap_round
from panelmill.operators.groups import with_group_standing
from panelmill.operators.series import rolling, series_window, with_previous
from panelmill.schemas import BARS, PanelSpec


def daily_returns(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Close, previous close and relative change; first rows of a series have nulls."""
    slim = bars.select(*dict.fromkeys([*spec.series_keys, *spec.identity, spec.close]))
    return with_previous(slim, "prev_close", spec.close, spec).withColumn(
        "daily_return", change(F.col(spec.close), F.col("prev_close"))
    )


def daily_price_change(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Change in percent with its direction, from each series' second row on."""
    close, prev = F.col(spec.close), F.col("prev_close")
    return (
        with_previous(bars, "prev_close", spec.close, spec)
        .where(prev.isNotNull())
        .select(
            *spec.identity, spec.close, "prev_close",
            snap_round(pct_change(close, prev), 2).alias("change_pct"),
            spec.volume,
            F.when(close > prev, "UP").when(close < prev, "DOWN").otherwise("FLAT")
            .alias("direction"),
        )
    )


def sector_performance_ranking(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Rounded returns with ranks and volume share among the group's bars of the day.

    A series' first bar has no return: it is left out before ranks and shares,
    but counts in the moving average of the bars that follow.
    """
    window = series_window(bars, spec)
    close, prev, ma20 = F.col(spec.close), F.col("prev_close"), F.col("_ma20")
    moves = (
        bars.select(*dict.fromkeys(
            [*spec.series_keys, *spec.identity, spec.close, spec.volume]))
        .withColumns({
            "prev_close": F.lag(spec.close).over(window),
            "_ma20": rolling("avg", spec.close, 20, window),
        })
        .where(prev.isNotNull())
        .withColumns({
            "_return": change(close, prev),
            "deviation_from_ma20": snap_round(pct_change(close, ma20), 2),
        })
        .drop("_ma20")
    )
    standing = with_group_standing(
        moves, [spec.group, spec.date], spec.series_keys,
        ranks={"return_rank": "_return", "volume_rank": spec.volume},
        totals={"_total": spec.volume},
        sized_by=bars,
    )
    return standing.select(
        spec.group, spec.entity, spec.date, spec.close,
        snap_round(pct_change(close, prev), 2).alias("daily_return"),
        spec.volume, "deviation_from_ma20", "return_rank", "volume_rank",
        snap_round(_share(spec.volume, "_total"), 2).alias("volume_share_pct"),
    )


def sector_performance_full(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """The unrounded ranking that keeps first bars, whose null return ranks last."""
    window = series_window(bars, spec)
    prices = [spec.open, spec.close, spec.high, spec.low, spec.volume]
    rows = bars.where(F.col(spec.close).isNotNull() & F.col(spec.group).isNotNull())
    moves = (
        rows.select(*dict.fromkeys(
            [*spec.series_keys, spec.group, spec.entity, spec.date, *prices, "year", "month"]))
        .withColumns({
            "prev_close": F.lag(spec.close).over(window),
            "ma20_deviation": F.col(spec.close) - rolling("avg", spec.close, 20, window),
        })
        .withColumn("_return", change(F.col(spec.close), F.col("prev_close")))
    )
    standing = with_group_standing(
        moves, [spec.group, spec.date], spec.series_keys,
        ranks={"return_rank_in_sector": "_return", "volume_rank_in_sector": spec.volume},
        totals={"_total": spec.volume},
        sized_by=rows,
    )
    return standing.select(
        spec.group, spec.entity, spec.date, *prices, "prev_close",
        (F.col("_return") * 100).alias("daily_return_pct"),
        "return_rank_in_sector", "volume_rank_in_sector",
        _share(spec.volume, "_total").alias("volume_share_pct"),
        "ma20_deviation", "year", "month",
    )


def _share(part: str, total: str):
    """Percent of the total, in doubles: decimal division would cut digits."""
    return ratio(F.col(part).cast("double") * 100, F.col(total))
