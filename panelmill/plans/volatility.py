"""Rolling risk figures per series."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.functions import change, classify, ratio, snap_round
from panelmill.operators.groups import with_group_standing
from panelmill.operators.series import with_previous, with_stitched_frames
from panelmill.plans.rankings import daily_returns
from panelmill.schemas import BARS, PanelSpec

TRADING_DAYS = 252


def volatility_analysis(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Annualised percentages over 20 and 60 returns, drawdown and risk class.

    The first bar has no return and leaves before the frames are built: its
    close is not part of any maximum. Sharpe ratio and class use the rounded
    figures.
    """
    frames = with_stitched_frames(
        daily_returns(bars, spec).where(F.col("prev_close").isNotNull()),
        "daily_return", spec.close, 20, 60, spec,
    ).where(F.col("_count60") > 1)  # one return has no deviation
    scale = math.sqrt(TRADING_DAYS)
    figures = frames.withColumns({
        "volatility_20d": snap_round(F.col("_sd20") * scale * 100, 2),
        "volatility_60d": snap_round(F.col("_sd60") * scale * 100, 2),
        "annualized_return_60d": snap_round(F.col("_mean60") * TRADING_DAYS * 100, 2),
    })
    peak, close = F.col("_peak60"), F.col(spec.close)
    return figures.select(
        *spec.identity, "volatility_20d", "volatility_60d", "annualized_return_60d",
        snap_round(ratio(F.col("annualized_return_60d"), F.col("volatility_60d")), 2)
        .alias("sharpe_ratio"),
        snap_round(ratio(peak - close, peak) * 100, 2).alias("max_drawdown_pct"),
        classify(F.col("volatility_60d"), [15, 25],
                 ["Low Risk", "Medium Risk", "High Risk"]).alias("risk_category"),
    )


def volatility_full(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Unrounded 20-row figures with four risk classes and the rank in the group.

    First bars stay: their null return is skipped by the frames, their close
    counts for the maximum.
    """
    close = F.col(spec.close)
    rows = bars.where(close.isNotNull())
    slim = rows.select(*dict.fromkeys(
        [*spec.series_keys, *spec.identity, spec.close, "year", "month"]))
    frames = (
        with_stitched_frames(
            with_previous(slim, "_prev", spec.close, spec)
            .withColumn("daily_return", change(close, F.col("_prev"))),
            "daily_return", spec.close, 20, 60, spec,
        )
        .where(F.col("_sd20").isNotNull())
        .withColumnsRenamed({
            "_sd20": "volatility_20d", "_sd60": "volatility_60d", "_mean20": "avg_return_20d",
        })
        .drop("_prev", "_count60", "_mean60", "_peak60")
    )
    # Ranked at ten decimals: equal series must tie whatever their last bits.
    standing = with_group_standing(
        frames.withColumn("_risk", snap_round(F.col("volatility_20d"), 10)),
        [spec.group, spec.date], spec.series_keys,
        ranks={"volatility_rank_in_sector": "_risk"},
        sized_by=rows,
    )
    sd, mean, drop = F.col("volatility_20d"), F.col("avg_return_20d"), close - F.col("_peak20")
    return standing.select(
        *spec.identity, spec.close, "daily_return", "volatility_20d", "volatility_60d",
        (sd * math.sqrt(TRADING_DAYS)).alias("annualized_volatility"),
        "avg_return_20d",
        (mean * TRADING_DAYS).alias("annualized_return"),
        F.when(sd > 0, ratio(mean, sd)).alias("sharpe_ratio_approx"),
        drop.alias("max_drawdown_20d"),
        (ratio(drop, close) * 100).alias("max_drawdown_pct"),
        "volatility_rank_in_sector",
        classify(sd, [0.01, 0.02, 0.03], ["Low", "Medium", "High", "Very High"])
        .alias("risk_category"),
        "year", "month",
    )
