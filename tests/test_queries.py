"""Every registered query against its SQL, and what must hold for any data."""

import pytest
from compare import difference
from pyspark.sql import functions as F

import __spark_entry__ as driver
from panelmill.contract import panels
from panelmill.contract.oracles import ORACLES
from panelmill.contract.queries import QUERIES
from panelmill.plans import build, lookups



def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, name):
    assert difference(QUERIES[name](spark, small), ORACLES[name], small) == ""


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.fixture(scope="module")
def bars(spark, small):
    return panels.bars(spark, small).cache()


def test_every_bar_is_kept(spark, small, bars):
    assert bars.count() == panels.raw_bars(spark, small).count()


def test_shares_add_up(bars):
    sums = build("sector_performance_ranking", bars).groupBy("sector", "date").agg(
        F.sum("volume_share_pct").alias("s"), F.count("*").alias("n"),
        F.min("return_rank").alias("r"), F.min("volume_rank").alias("v"))
    assert sums.where("abs(s - 100) > 0.005 * n + 1e-9 OR r <> 1 OR v <> 1").isEmpty()


def test_volatility_rows_and_signs(bars):
    view = build("volatility_analysis", bars).cache()
    per_ticker = bars.groupBy("ticker").count()
    lost = per_ticker.select(F.sum(F.least("count", F.lit(2)))).first()[0]
    assert view.count() == bars.count() - lost
    assert view.where("max_drawdown_pct < 0").isEmpty()
    assert build("volatility_full", bars).where("max_drawdown_pct > 0").isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_plan_has_two_exchanges_at_most_on_stored_bars(bars):
    """One by entity for lag and average, unless the bars come so, and one by group and day for all ranks."""
    text = plan(build("sector_performance_ranking", bars))
    text = text[:text.index("InMemoryRelation")]
    assert 1 <= text.count("Exchange hashpartitioning") <= 2
    assert "SinglePartition" not in text


def test_small_master_is_broadcast_by_size_only(spark, small):
    df = panels.bars(spark, small)
    df.collect()
    assert "BroadcastHashJoin [ticker" in plan(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = panels.bars(spark, small)
        df.collect()
        assert "SortMergeJoin [ticker" in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_keeps_only_k_rows_per_task(bars):
    text = plan(lookups.top_sectors(build("cross_sector_comparison", bars)))
    assert "TakeOrderedAndProject" in text


def test_scan_reads_only_needed_columns(spark, small):
    text = plan(build("sector_daily_summary", panels.bars(spark, small)))
    scan = [line for line in text.split("\n") if "lineitem.parquet" in line][0]
    assert "l_tax" not in scan and "l_comment" not in scan and "l_discount" not in scan
