"""What loads have changed, and how far a change reaches.

Every load leaves a batch beside the bars: the (entity, group, date) that it
writes, and the groups under which those days were stored before. A refresh turns the
batches into months to build anew, and into the months it has to read for that, by
two small tables of rows per month: of each series and of each group.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelmill.durable import file_exists, subfolders
from panelmill.schemas import BARS, PROCESSED_BARS, PanelSpec
from panelmill.sinks.snapshots import Month, month_columns, new_version
from panelmill.sources.processed import in_months

KEYS = ["ticker", "sector", "date"]


def changes_of(processed: str) -> str:
    return f"{processed.rstrip('/')}_changes"


def log_changes(bars: DataFrame, processed: str) -> str:
    """Store which bars a load is about to write, and their former groups; the batch's name.

    Only the months of the new bars are read for the former groups, in three columns. It
    comes before the write, so that no stored change goes unnoticed; a load that is cut
    off or repeated only makes some months be built again.
    """
    spark = bars.sparkSession
    batch = new_version()
    new = bars.select(*KEYS).distinct()
    if file_exists(spark, processed):
        touched = months_of(new)
        stored = in_months(spark.read.schema(PROCESSED_BARS).parquet(processed), touched)
        same = F.col("n.ticker").eqNullSafe(F.col("s.ticker")) & F.col("n.date").eqNullSafe(F.col("s.date"))
        former = stored.select(*KEYS).alias("s").join(new.select("ticker", "date").distinct().alias("n"), same, "left_semi")
        new = new.unionByName(former).distinct()
    new.write.parquet(f"{changes_of(processed)}/{batch}")
    return batch


def batches(spark: SparkSession, processed: str) -> list[str]:
    return subfolders(spark, changes_of(processed))


def months_of(df: DataFrame, date: str = "date") -> list[Month]:
    """The months of the rows, at most twelve a year; (0, 0) for rows without a date."""
    return [(r["y"], r["m"]) for r in df.select(*[c.alias(n) for n, c in month_columns(df, date=date).items()]).distinct().collect()]


def series_months(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Rows of each series per month."""
    rows = bars.withColumns(month_columns(bars, date=spec.date))
    return rows.groupBy(*spec.series_keys, "y", "m").agg(F.count(F.lit(1)).alias("n"))


def group_months(bars: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """Different dates of each group per month."""
    rows = bars.withColumns(month_columns(bars, date=spec.date))
    return rows.groupBy(spec.group, "y", "m").agg(F.count_distinct(F.coalesce(spec.date, F.lit("0001-01-01").cast("date"))).alias("n"))


def dirty_months(per_month: DataFrame, keys: list[str], touched: DataFrame, reach: int) -> list[Month]:
    """Months with rows that lie up to ``reach`` rows after a touched month of the same key.

    ``per_month`` (keys, y, m, n) counts the rows as they are now, ``touched`` has
    keys, y and m. A window sees the months of one key.
    """
    mine = touched.select(*keys).distinct()
    same = [per_month[k].eqNullSafe(mine[k]) for k in keys]
    rows = per_month.join(mine, same, "left_semi").select(*keys, "y", "m", "n", F.lit(0).alias("t")).unionByName(
        touched.select(*keys, "y", "m", F.lit(0).cast("long").alias("n"), F.lit(1).alias("t")).distinct())
    rows = rows.groupBy(*keys, "y", "m").agg(F.sum("n").alias("n"), F.max("t").alias("t"))
    along = Window.partitionBy(*keys).orderBy("y", "m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("n").over(along))
    reached = F.max(F.when(F.col("t") == 1, F.col("upto"))).over(along)
    rows = rows.withColumn("gap", F.col("upto") - F.col("n") - reached)
    dirty = rows.where((F.col("t") == 1) | (F.col("gap") < reach))
    return sorted((r["y"], r["m"]) for r in dirty.select("y", "m").distinct().collect())


def needed_months(per_month: DataFrame, keys: list[str], months: Iterable[Month], before: int) -> list[Month]:
    """``months``, and those that hold any of the ``before`` rows in front of them, for some key."""
    inside = (F.col("y") * 100 + F.col("m")).isin([y * 100 + m for y, m in months])
    order = Window.partitionBy(*keys).orderBy("y", "m")
    rows = per_month.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    later = order.rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("next", F.min(F.when(inside, F.col("upto") - F.col("n"))).over(later))
    needed = rows.where(inside | (F.col("next") - F.col("upto") < before))
    return sorted({(r["y"], r["m"]) for r in needed.select("y", "m").distinct().collect()} | set(months))
