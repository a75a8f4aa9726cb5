"""Curated views by name, with the order their rows are shown in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.plans import cross_group, rankings, summaries, volatility
from panelmill.schemas import BARS, PanelSpec


@dataclass(frozen=True)
class Curated:
    """``order`` lists column names, newest first with a leading minus.

    ``by_month`` marks the views that show year and month. ``reach`` is the number of rows, along the
    ``series`` or the ``group``, over which a changed bar is felt, and which
    a row needs before it; ``month`` is the column that says in which month a row is stored.
    """

    build: Callable[..., DataFrame]
    order: tuple[str, ...]
    by_month: bool = False
    along: str = "series"
    reach: int = 0
    month: str = "date"


CURATED: dict[str, Curated] = {
    "sector_daily_summary": Curated(
        summaries.sector_daily_summary, ("-date", "sector")),
    "ticker_monthly_summary": Curated(
        summaries.ticker_monthly_summary, ("ticker", "-month"), month="month"),
    "sector_performance_ranking": Curated(
        rankings.sector_performance_ranking, ("-date", "sector", "return_rank"), reach=21),
    "cross_sector_comparison": Curated(
        cross_group.cross_sector_comparison, ("-date", "performance_rank"), along="group", reach=32),
    "volatility_analysis": Curated(
        volatility.volatility_analysis, ("-date", "ticker"), reach=62),
    "sector_performance_full": Curated(
        rankings.sector_performance_full, ("-date", "sector", "return_rank_in_sector"),
        True, reach=21),
    "cross_sector_full": Curated(
        cross_group.cross_sector_full, ("-date", "performance_rank"), True, along="group", reach=32),
    "volatility_full": Curated(
        volatility.volatility_full, ("-date", "-volatility_20d"), True, reach=62),
    "daily_price_change": Curated(
        rankings.daily_price_change, ("-date", "ticker"), reach=2),
}

# The views that every refresh rebuilds unless told otherwise.
DEFAULT_VIEWS = (
    "sector_daily_summary", "ticker_monthly_summary", "sector_performance_ranking",
    "cross_sector_comparison", "volatility_analysis",
)


def build(name: str, bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """The view's rows in no particular order."""
    return CURATED[name].build(bars, spec)


def sort_columns(name: str, spec: PanelSpec = BARS) -> list[Column]:
    roles = {"ticker": spec.entity, "sector": spec.group, "date": spec.date}
    out = []
    for item in CURATED[name].order:
        column = item.lstrip("-")
        column = roles.get(column, column)
        out.append(F.desc_nulls_last(column) if item.startswith("-") else F.asc(column))
    return out


def ordered(name: str, view: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """The view in display order: a global sort, for reading rather than storing."""
    return view.orderBy(*sort_columns(name, spec))
