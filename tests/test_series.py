"""Windows along a series."""

import pytest
from pyspark.sql import functions as F

from panelmill.operators import with_previous, with_rolling, with_stitched_frames


def series(spark):
    days = spark.range(400).select(
        F.when(F.col("id") < 300, "A").when(F.col("id") < 390, "B")
        .when(F.col("id") < 399, "C").otherwise("D").alias("ticker"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        (100 + 30 * F.sin("id") + F.pmod("id", F.lit(7))).alias("close"),
        F.when(F.col("id") % 11 == 3, None).when(F.col("id").between(100, 180), 0.25)
        .otherwise(F.cos("id") * 1000).alias("r"),
    )
    return days


def test_stitched_frames_equal_sliding_frames(spark):
    df = series(spark)
    direct = with_rolling(df, {
        "sd20": ("stddev", "r", 20), "mean20": ("avg", "r", 20), "peak20": ("max", "close", 20),
        "sd60": ("stddev", "r", 60), "mean60": ("avg", "r", 60), "peak60": ("max", "close", 60),
    })
    both = with_stitched_frames(direct, "r", "close", 20, 60)
    for name in ("sd20", "mean20", "peak20", "sd60", "mean60", "peak60"):
        a, b = F.col(name), F.col(f"_{name}")
        wrong = both.where(
            (a.isNull() != b.isNull()) | (F.abs(a - b) > 1e-9 * F.greatest(F.abs(a), F.lit(1e-3)))
        )
        assert wrong.isEmpty(), name
    # A frame of equal values has no deviation at all.
    flat = both.where("date BETWEEN DATE'2020-01-01' + 160 AND DATE'2020-01-01' + 180")
    assert flat.where("_sd60 <> 0").isEmpty() and flat.count() == 21


def test_one_exchange_for_lag_and_frames(spark):
    df = with_stitched_frames(
        with_previous(series(spark), "p", "close"), "r", "close", 20, 60)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ticker") == 1
    assert plan.count("Sort [ticker") == 1
    assert "SinglePartition" not in plan


def test_finer_times_are_refused(spark):
    df = series(spark).withColumn("date", F.col("date").cast("timestamp"))
    with pytest.raises(TypeError, match="must be a date"):
        with_previous(df, "p", "close")


def test_a_filter_on_a_long_frame_does_not_repeat_its_making(spark):
    """The condition on the class names the long deviation, not the formula that puts it together from short frames."""
    from panelmill.plans.lookups import of_risk
    from panelmill.plans.volatility import volatility_analysis

    bars = series(spark).withColumn("sector", F.lit("S"))
    plan = of_risk(volatility_analysis(bars), "High Risk")._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if "Filter" in line]
    assert conditions and all("sqrt" not in line.lower() and "_part" not in line for line in conditions), plan
