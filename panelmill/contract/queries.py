"""The registered queries: one per operator or view, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill import plans
from panelmill.contract import panels
from panelmill.functions import (
    date_parts, decode_key, last_segment, parse_names, pct_change, ratio, snap_round,
)
from panelmill.operators import (
    dedupe_bars, enrich, entity_counts, ingest_report, ingest_totals, latest_per_entity,
    upsert_by_key, with_group_standing, with_rolling, with_stitched_frames,
)
from panelmill.plans import lookups, rankings, summaries

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries, shared with their SQL.
SINCE_YEAR = 1998
MONTH = "11"
SECTOR = "ASIA"
TICKERS = "T0000000001, T0000000003 ,T0000000005"
UPSERT_DAY = "2024-06-01"
SEED_DAY = "2024-01-01"


def snapped(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column, so that summation order does not show."""
    return df.select(*[
        snap_round(F.col(f.name), special.get(f.name, digits)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema
    ])


def _view(name: str, spark: SparkSession, sf: str) -> DataFrame:
    return plans.build(name, panels.bars(spark, sf))


def _curated(name: str) -> Query:
    return lambda spark, sf: _view(name, spark, sf)


def _curated_unrounded(name: str, **special: int) -> Query:
    return lambda spark, sf: snapped(_view(name, spark, sf), **special)


def bars_enriched(spark, sf):
    processed = enrich(panels.raw_bars(spark, sf), panels.master(spark, sf))
    return processed.drop("ingested_at", "fetched_at")


def bars_no_master(spark, sf):
    return enrich(panels.raw_bars(spark, sf), None).drop("ingested_at", "fetched_at")


def order_date_parts(spark, sf):
    orders = panels.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    )
    return date_parts(orders)


def source_file_name(spark, sf):
    pages = panels.table(spark, sf, "pages")
    return pages.select(
        "page_id", last_segment(F.col("url")).alias("source_file"),
        last_segment(decode_key(F.url_encode("url"))).alias("decoded_file"),
    )


def ticker_filter(spark, sf):
    bars = panels.bars(spark, sf).where(F.col("ticker").isin(parse_names(TICKERS)))
    return bars.select("ticker", "date", "close", "volume")


def dedupe(spark, sf):
    feed = panels.refetched(panels.raw_bars(spark, sf))
    return dedupe_bars(feed).withColumn("fetched_at", F.to_date("fetched_at"))


def master_upsert(spark, sf):
    """Suppliers in debt are new to the master, rich ones change their labels."""
    seeded = F.lit(SEED_DAY).cast("timestamp")
    old = panels.master(spark, sf).withColumns({"created_at": seeded, "updated_at": seeded})
    new = (
        panels.table(spark, sf, "supplier")
        .where("s_acctbal < 0 OR s_acctbal > 5000")
        .select(
            panels.ticker("s_suppkey").alias("ticker"),
            F.upper("s_name").alias("name"), F.lit("Watched").alias("sector"),
            F.lit(None).cast("string").alias("exchange"),
            F.col("s_nationkey").cast("string").alias("country"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )
    )
    merged = upsert_by_key(old, new, "ticker", F.lit(UPSERT_DAY).cast("timestamp"))
    return merged.withColumns({
        c: F.to_date(c) for c in ("created_at", "updated_at")
    })


def latest_bar(spark, sf):
    bars = panels.bars(spark, sf)
    return latest_per_entity(bars).select(
        "ticker", "sector", "date", "open", "high", "low", "close", "volume"
    )


def _report(spark, sf) -> DataFrame:
    """Every supplier and every nation is asked for; nations have no bars."""
    suppliers = panels.table(spark, sf, "supplier")
    nations = panels.table(spark, sf, "nation")
    requested = suppliers.select(panels.ticker("s_suppkey").alias("ticker")).unionByName(
        nations.select(F.col("n_name").alias("ticker"))
    )
    errors = suppliers.where("s_acctbal < 0").select(
        panels.ticker("s_suppkey").alias("ticker"), F.lit("in debt").alias("error")
    )
    return ingest_report(requested, panels.raw_bars(spark, sf), errors)


def moving_average(spark, sf):
    bars = panels.bars(spark, sf).select("ticker", "date", "close")
    return snapped(with_rolling(bars, {"ma20": ("avg", "close", 20)}))


def rolling_volatility(spark, sf):
    returns = rankings.daily_returns(panels.bars(spark, sf))
    frames = with_stitched_frames(returns, "daily_return", "close", 20, 60)
    names = ("sd20", "sd60", "mean20", "mean60")
    return snapped(frames.select("ticker", "date", *[F.col(f"_{n}").alias(n) for n in names]))


def rolling_drawdown(spark, sf):
    bars = panels.bars(spark, sf).select("ticker", "date", "close")
    peaks = with_rolling(bars, {"max20": ("max", "close", 20), "max60": ("max", "close", 60)})
    return snapped(peaks.withColumns({
        "drawdown20_pct": pct_change(F.col("close"), F.col("max20")),
        "drawdown60_pct": pct_change(F.col("close"), F.col("max60")),
    }))


def volume_share(spark, sf):
    bars = panels.bars(spark, sf).select("sector", "ticker", "date", "volume")
    shares = with_group_standing(
        bars, ["sector", "date"], ["ticker"], ranks={}, totals={"sector_volume": "volume"}
    )
    return snapped(shares.withColumn(
        "share_pct", ratio(F.col("volume").cast("double") * 100, F.col("sector_volume"))
    ))


def enriched_view(spark, sf):
    return lookups.enriched_view(panels.bars(spark, sf), SINCE_YEAR).drop("ingested_at")


def sector_view(spark, sf):
    """The sector's rows of its first ticker, which depends on the data."""
    bars = panels.bars(spark, sf)
    first = bars.where(F.col("sector") == SECTOR).agg(F.min("ticker")).scalar()
    return lookups.sector_view(bars, SECTOR, SINCE_YEAR, first)


def sector_view_all(spark, sf):
    return lookups.sector_view(panels.bars(spark, sf), SECTOR, SINCE_YEAR)


def named_sector_daily(spark, sf):
    view = snapped(summaries.named_sector_daily(panels.bars(spark, sf), SINCE_YEAR, MONTH))
    return view.orderBy("sector", F.desc("date"))


def named_sector_comparison(spark, sf):
    view = snapped(summaries.named_sector_comparison(panels.bars(spark, sf), SINCE_YEAR))
    return view.orderBy(F.desc("total_volume"))


def latest_ranking(spark, sf):
    bars = panels.bars(spark, sf)
    newest = lookups.newest_move(panels.raw_bars(spark, sf).select("ticker", "date"))
    return lookups.latest_day(plans.build("sector_performance_ranking", bars), newest=newest)


def top_sectors(spark, sf):
    return lookups.top_sectors(_view("cross_sector_comparison", spark, sf))


def high_risk_rows(spark, sf):
    return lookups.of_risk(_view("volatility_analysis", spark, sf), "High Risk")


def high_latest(spark, sf):
    calm = panels.damped(panels.bars(spark, sf))
    return lookups.highest_risk(snapped(plans.build("volatility_full", calm)), "High")


def latest_sector_days(spark, sf):
    return lookups.latest_rows(_view("sector_daily_summary", spark, sf))


def dedupe_sector_change(spark, sf):
    stored = panels.resent_elsewhere(panels.bars(spark, sf))
    return dedupe_bars(stored).select("sector", "ticker", "date", "close")


def _activity(name: str) -> Query:
    return lambda spark, sf: plans.build(
        name, panels.activity(spark, sf), panels.ACTIVITY)


QUERIES: dict[str, Query] = {
    "bars_enriched": bars_enriched,
    "bars_no_master": bars_no_master,
    "date_parts": order_date_parts,
    "source_file_name": source_file_name,
    "ticker_filter": ticker_filter,
    "dedupe_bars": dedupe,
    "master_upsert": master_upsert,
    "latest_bar": latest_bar,
    "ticker_counts": lambda spark, sf: entity_counts(panels.bars(spark, sf)),
    "ingest_report": _report,
    "ingest_totals": lambda spark, sf: ingest_totals(_report(spark, sf)),
    "daily_returns": lambda spark, sf: snapped(
        rankings.daily_returns(panels.bars(spark, sf))),
    "moving_average": moving_average,
    "rolling_volatility": rolling_volatility,
    "rolling_drawdown": rolling_drawdown,
    "volume_share": volume_share,
    "sector_daily_summary": _curated("sector_daily_summary"),
    "ticker_monthly_summary": _curated("ticker_monthly_summary"),
    "sector_performance_ranking": _curated("sector_performance_ranking"),
    "cross_sector_comparison": _curated("cross_sector_comparison"),
    "volatility_analysis": _curated("volatility_analysis"),
    "sector_performance_full": _curated_unrounded("sector_performance_full"),
    "cross_sector_full": _curated_unrounded("cross_sector_full", money_flow_indicator=4),
    "volatility_full": _curated_unrounded("volatility_full"),
    "enriched_view": enriched_view,
    "sector_view": sector_view,
    "sector_view_all": sector_view_all,
    "named_sector_daily": named_sector_daily,
    "named_sector_comparison": named_sector_comparison,
    "daily_price_change": _curated("daily_price_change"),
    "latest_ranking": latest_ranking,
    "top_sectors": top_sectors,
    "high_risk_rows": high_risk_rows,
    "high_latest": high_latest,
    "latest_sector_days": latest_sector_days,
    "dedupe_sector_change": dedupe_sector_change,
    "activity_daily_summary": _activity("sector_daily_summary"),
    "activity_ranking": _activity("sector_performance_ranking"),
    "activity_volatility": _activity("volatility_analysis"),
}

FLAGSHIP = "volatility_analysis"

