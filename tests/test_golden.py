"""Hand-computed answers on a six-row panel, and the awkward rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelmill.functions import classify, clean_group, date_parts, decode_key, parse_names
from panelmill.operators import with_stitched_frames
from panelmill.plans import build
from panelmill.plans.lookups import highest_risk, latest_day, top_sectors

SCHEMA = ("ticker string, sector string, date string, open double, high double, low double, "
          "close double, volume bigint")


def panel(spark, rows):
    """rows: (ticker, sector, date, close, volume)"""
    full = [(t, s, d, c, c, c, c, v) for t, s, d, c, v in rows]
    return date_parts(spark.createDataFrame(full, SCHEMA))


@pytest.fixture(scope="module")
def micro(spark):
    return panel(spark, [
        ("AAA", "Tech", "2024-01-01", 100.0, 200), ("AAA", "Tech", "2024-01-02", 110.0, 300),
        ("AAA", "Tech", "2024-01-03", 99.0, 100), ("BBB", "Tech", "2024-01-01", 50.0, 100),
        ("BBB", "Tech", "2024-01-02", 50.0, 100), ("BBB", "Tech", "2024-01-03", 55.0, 100),
    ])


def table(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_ranking(micro):
    got = table(build("sector_performance_ranking", micro).withColumn("d", F.day("date")),
                "ticker", "d", "daily_return", "deviation_from_ma20", "return_rank",
                "volume_rank", "volume_share_pct")
    assert got == [
        ("AAA", 2, 10.0, 4.76, 1, 1, 75.0), ("AAA", 3, -10.0, -3.88, 2, 1, 50.0),
        ("BBB", 2, 0.0, 0.0, 2, 2, 25.0), ("BBB", 3, 10.0, 6.45, 1, 1, 50.0)]


def test_ranking_full_keeps_first_rows(micro):
    got = table(build("sector_performance_full", micro).where("day(date) = 1"),
                "ticker", "prev_close", "daily_return_pct", "return_rank_in_sector",
                "volume_rank_in_sector", "ma20_deviation", "month")
    assert got == [("AAA", None, None, 1, 1, 0.0, "01"), ("BBB", None, None, 1, 2, 0.0, "01")]


def test_cross_sector(micro):
    got = table(build("cross_sector_comparison", micro).withColumn("d", F.day("date")),
                "d", "avg_close", "sector_daily_return_pct", "ma7", "ma30", "trend",
                "money_flow_indicator", "performance_rank")
    assert got == [(2, 80.0, 6.67, 77.5, 77.5, "Neutral", None, 1),
                   (3, 77.0, -3.75, 77.33, 77.33, "Neutral", -50.0, 1)]


def test_cross_sector_full(micro):
    rows = build("cross_sector_full", micro).select(
        F.day("date"), F.round("volume_change_pct", 6), F.round("money_flow_indicator", 4))
    assert table(rows, "*") == [(1, None, None), (2, 33.333333, 26.6667), (3, -50.0, -7.5)]


def test_volatility(micro):
    got = table(build("volatility_analysis", micro), "ticker", "date", "volatility_20d",
                "volatility_60d", "annualized_return_60d", "sharpe_ratio", "max_drawdown_pct",
                "risk_category")
    day = dt.date(2024, 1, 3)
    assert got == [
        ("AAA", day, 224.5, 224.5, 0.0, 0.0, 10.0, "High Risk"),
        ("BBB", day, 112.25, 112.25, 1260.0, 11.22, 0.0, "High Risk")]


def test_price_change(micro):
    got = table(build("daily_price_change", micro), "ticker", "change_pct", "direction")
    assert got == [("AAA", -10.0, "DOWN"), ("AAA", 10.0, "UP"),
                   ("BBB", 0.0, "FLAT"), ("BBB", 10.0, "UP")]


def test_summaries(micro):
    daily = table(build("sector_daily_summary", micro).where("day(date) = 2"), "*")
    assert daily == [("Tech", dt.date(2024, 1, 2), 2, 80.0, 200.0, 50.0, 110.0)]
    monthly = table(build("ticker_monthly_summary", micro), "*")
    assert monthly[0] == ("AAA", "Tech", dt.date(2024, 1, 1), 103.0, 110.0, 99.0, 600, 3)


def test_lookups(micro):
    assert latest_day(build("sector_performance_ranking", micro)).count() == 2
    top = top_sectors(build("cross_sector_comparison", micro), 1).collect()
    assert [r["date"] for r in top] == [dt.date(2024, 1, 3)]
    assert highest_risk(build("volatility_analysis", micro), "High Risk", 1).first()[0] == "AAA"


def test_constant_price_has_no_risk(spark):
    rows = [("AAA", "S", f"2024-01-{d:02d}", 7.0, 1) for d in range(1, 29)]
    got = table(build("volatility_analysis", panel(spark, rows)).distinct(),
                "volatility_60d", "sharpe_ratio", "max_drawdown_pct", "risk_category")
    assert set(got) == {(0.0, None, 0.0, "Low Risk")}
    full = build("volatility_full", panel(spark, rows))
    assert {r[0] for r in full.select("sharpe_ratio_approx").collect()} == {None}
    assert {r[0] for r in full.select("risk_category").collect()} == {"Low"}


def test_risk_classes_on_scaled_prices(spark):
    """Calmer and calmer series reach every class of both views."""
    rows = []
    for ticker, swing in [("A", 0.002), ("B", 0.01), ("C", 0.0125), ("D", 0.08)]:
        rows += [(ticker, "S", str(dt.date(2024, 1, 1) + dt.timedelta(i)),
                  100 * (1 + swing * (i % 2)), 1) for i in range(80)]
    bars = panel(spark, rows)
    last = F.col("date") == "2024-03-20"
    coarse = dict(table(build("volatility_analysis", bars).where(last), "ticker",
                        "risk_category"))
    assert coarse == {"A": "Low Risk", "B": "Medium Risk", "C": "Medium Risk", "D": "High Risk"}
    fine = dict(table(build("volatility_full", bars).where(last), "ticker", "risk_category"))
    assert fine == {"A": "Low", "B": "Medium", "C": "Medium", "D": "Very High"}


def test_class_bounds_are_exclusive(spark):
    df = spark.createDataFrame([(14.99,), (15.0,), (24.99,), (25.0,), (None,)], "v double")
    got = df.select("v", classify(F.col("v"), [15, 25], ["L", "M", "H"]).alias("c")).collect()
    assert [r["c"] for r in got] == ["L", "M", "M", "H", None]


def test_zero_previous_close_gives_no_return(spark):
    bars = panel(spark, [("A", "S", "2024-01-01", 0.0, 1), ("A", "S", "2024-01-02", 5.0, 1),
                         ("B", "S", "2024-01-01", 4.0, 1), ("B", "S", "2024-01-02", 5.0, 0)])
    got = table(build("sector_performance_ranking", bars), "ticker", "daily_return",
                "return_rank", "volume_share_pct")
    assert got == [("A", None, 2, 100.0), ("B", 25.0, 1, 0.0)]
    assert table(build("daily_price_change", bars), "ticker", "change_pct", "direction") == [
        ("A", None, "UP"), ("B", 25.0, "UP")]


def test_zero_group_volume_gives_no_share(spark):
    bars = panel(spark, [("A", "S", "2024-01-01", 1.0, 0), ("A", "S", "2024-01-02", 5.0, 0)])
    assert table(build("sector_performance_ranking", bars), "volume_share_pct") == [(None,)]


def test_single_bar_and_null_group(spark):
    bars = panel(spark, [("ONE", "S", "2024-01-01", 1.0, 1),
                         ("TWO", None, "2024-01-01", 1.0, 1), ("TWO", None, "2024-01-02", 2.0, 1)])
    assert table(build("sector_performance_ranking", bars), "ticker", "return_rank") == [
        ("TWO", 1)]
    assert build("volatility_analysis", bars).isEmpty()
    assert table(build("sector_performance_full", bars), "ticker") == [("ONE",)]
    assert table(build("cross_sector_full", bars), "sector") == [("S",)]


def test_tied_ranks_skip(spark):
    rows = []
    for ticker, close in [("A", 2.0), ("B", 2.0), ("C", 1.5)]:
        rows += [(ticker, "S", "2024-01-01", 1.0, 1), (ticker, "S", "2024-01-02", close, 1)]
    got = dict(table(build("sector_performance_ranking", panel(spark, rows)), "ticker",
                     "return_rank"))
    assert got == {"A": 1, "B": 1, "C": 3}


def test_trend_labels_and_tied_sectors(spark):
    rows = []
    for i in range(12):
        day = str(dt.date(2024, 1, 1) + dt.timedelta(i))
        rows += [("U", "up", day, 10.0 + i, 1), ("V", "up_too", day, 10.0 + i, 1),
                 ("D", "down", day, 30.0 - i, 1)]
    last = build("cross_sector_comparison", panel(spark, rows)).where("date = '2024-01-12'")
    assert table(last, "sector", "trend", "performance_rank") == [
        ("down", "Bearish", 3), ("up", "Bullish", 1), ("up_too", "Bullish", 1)]


def test_series_with_several_groups(spark):
    """An entity in two groups on one day keeps two separate histories."""
    from panelmill.contract.panels import ACTIVITY

    bars = panel(spark, [("7", "a", "2024-01-01", 1.0, 1), ("7", "b", "2024-01-01", 10.0, 1),
                         ("7", "a", "2024-01-02", 2.0, 1), ("7", "b", "2024-01-02", 5.0, 3)])
    renamed = bars.withColumnsRenamed({"ticker": "user_id", "sector": "event_type"})
    got = table(build("sector_performance_ranking", renamed, ACTIVITY), "event_type",
                "user_id", "daily_return", "volume_share_pct")
    assert got == [("a", "7", 100.0, 100.0), ("b", "7", -50.0, 100.0)]


def test_hot_group_gives_the_same_views(spark, small, monkeypatch):
    """Views with every larger group split equal the plain ones."""
    from panelmill.contract import panels
    from panelmill.operators import groups
    from panelmill.plans import rankings, volatility

    bars = panels.bars(spark, small)
    for view in (rankings.sector_performance_ranking, volatility.volatility_full):
        plain = view(bars)
        with monkeypatch.context() as patch:
            patch.setattr(groups, "TASK_BYTES", 0)
            patch.setattr(groups, "_slots", lambda df: 2000)
            split = view(bars)
        assert split.columns == plain.columns
        assert split.count() == plain.count()
        assert split.exceptAll(plain).isEmpty()


def test_long_frame_must_fit(spark, micro):
    with pytest.raises(ValueError):
        with_stitched_frames(micro, "close", "close", 20, 50)


def test_text_helpers(spark):
    assert parse_names(" AAPL, MSFT ,,GOOGL") == ["AAPL", "MSFT", "GOOGL"]
    row = spark.range(1).select(
        clean_group(F.lit("Real  Estate")), clean_group(F.lit(None).cast("string")),
        decode_key(F.lit("raw/A+B/x%20y%2Bz.csv"))).first()
    assert tuple(row) == ("Real__Estate", "Unknown", "raw/A B/x y+z.csv")


def test_constant_price_has_no_trend(spark):
    from panelmill.plans import build

    rows = [(g, f"{g}{i}", dt.date(2024, 1, 1) + dt.timedelta(days=d), 0.1, 5)
            for g in "ab" for i in range(3) for d in range(40)]
    flat = spark.createDataFrame(rows, "sector string, ticker string, date date, close double, volume bigint")
    got = build("cross_sector_comparison", flat).collect()
    assert {r.trend for r in got} == {"Neutral"} and {r.performance_rank for r in got} == {1}
