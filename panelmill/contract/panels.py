"""Panels derived from the benchmark tables, for the registered queries.

Suppliers are the entities, their regions the groups, ship dates the days. The
master leaves out suppliers in debt, so that some bars find no group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.operators import enrich
from panelmill.schemas import PanelSpec

DAMPING = 1_000_000.0
ACTIVITY = PanelSpec(
    entity="user_id", group="event_type", date="date", series=("user_id", "event_type")
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticker(key: str):
    return F.concat(F.lit("T"), F.lpad(F.col(key).cast("string"), 10, "0"))


def _sale_position():
    """Order and line, which are the key of a sale, as one number that sorts like them.

    A line number may have ten digits, all that an integer has. Unlike a struct, a decimal can
    be updated in place, so the aggregate hashes instead of sorting its input.
    """
    order = F.col("l_orderkey").cast("decimal(20,0)") * F.lit(10**10).cast("decimal(11,0)")
    return order + F.col("l_linenumber").cast("decimal(10,0)")


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per supplier and ship date; the first and last sale by order
    and line give open and close."""
    days = (
        table(spark, sf_dir, "lineitem")
        .withColumn("sale", _sale_position())
        .groupBy("l_suppkey", F.to_date("l_shipdate").alias("date"))
        .agg(
            F.min_by("l_extendedprice", "sale").alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max_by("l_extendedprice", "sale").alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
    )
    return days.select(
        ticker("l_suppkey").alias("ticker"), "date", "open", "high", "low", "close", "volume",
        F.date_add("date", 1).cast("timestamp").alias("fetched_at"),
        F.concat_ws("", ticker("l_suppkey"), F.lit("_"), F.col("date"), F.lit(".csv"))
        .alias("source_file"),
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier").where("s_acctbal >= 0")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            ticker("s_suppkey").alias("ticker"), F.col("s_name").alias("name"),
            F.col("r_name").alias("sector"), F.col("n_name").alias("exchange"),
            F.col("r_name").alias("country"), F.lit(True).alias("is_active"),
        )
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(raw_bars(spark, sf_dir), master(spark, sf_dir))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values per user, event type and day: the same panel under other names."""
    at = F.struct("ts", "event_id", "value")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type", F.to_date("ts").alias("date"))
        .agg(
            F.min(at)["value"].alias("open"), F.max("value").alias("high"),
            F.min("value").alias("low"), F.max(at)["value"].alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def damped(bars: DataFrame) -> DataFrame:
    """The bars with closes far above their daily moves, so that risk classes below the highest occur."""
    return bars.withColumn("close", F.col("close") + DAMPING)


def resent_elsewhere(bars: DataFrame) -> DataFrame:
    """Stored bars of which every tenth ticker was loaded again from the same files, after a change of group."""
    again = bars.where(F.substring("ticker", -1, 1) == "0").withColumns({
        "sector": F.concat(F.lit("A_"), "sector"),
        "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
    })
    return bars.unionByName(again)


def refetched(raw: DataFrame) -> DataFrame:
    """The feed with every bar that closed below its open sent again, corrected."""
    again = raw.where(F.col("close") < F.col("open")).withColumns({
        "close": F.col("close") + 1,
        "fetched_at": F.date_add("date", 2).cast("timestamp"),
        "source_file": F.concat(F.lit("fix_"), "source_file"),
    })
    return raw.unionByName(again)
