"""Writers of files in folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelmill.durable import drop_folder, file_exists, partition_folders, subfolders
from panelmill.operators.rows import dedupe_bars
from panelmill.schemas import BARS, PROCESSED_BARS, PanelSpec

LAYOUTS = {
    # One folder per bar's day: what a per-day reader expects, but one small
    # file per entity and day.
    "full": ["sector", "ticker", "year", "month", "day"],
    # One folder per group and month, entities sorted inside the files.
    "compact": ["sector", "year", "month"],
}


def write_raw(bars: DataFrame, root: str, spec: PanelSpec = BARS) -> None:
    """Raw CSV files with header, in folders per entity and day.

    The folder columns are copies, so that the files keep every column.
    """
    day = F.col(spec.date)
    folders = {
        "entity_key": F.col(spec.entity),
        "y": F.date_format(day, "yyyy"), "m": F.date_format(day, "MM"),
        "d": F.date_format(day, "dd"),
    }
    rows = bars.withColumns(folders)
    (
        _balanced(rows, ["entity_key", "y", "m", "d"])
        .write.mode("append").option("header", True)
        .partitionBy(*folders).csv(root)
    )


def _balanced(df: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows of a folder together, so that it gets few files.

    Adaptive rebalancing splits a folder that holds much of the data over
    several tasks and joins small ones.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*keys, *within)


def write_processed(
    bars: DataFrame,
    path: str,
    layout: str = "compact",
    mode: str = "append",
    staging: str | None = None,
) -> Observation:
    """Store processed bars as snappy Parquet; returns the written row count.

    ``append`` adds files. ``replace`` makes the rows the only ones of their
    (entity, date), so that a replay changes nothing. The observation's
    ``rows`` and ``entities`` come from the write itself.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode}")
    keys = LAYOUTS[layout]
    counts = Observation()
    rows = bars.select(*PROCESSED_BARS.names)
    if mode == "replace":
        rows = dedupe_bars(rows)
    if mode == "replace" and layout == "compact":
        if staging is None:
            raise ValueError("replacing in the compact layout needs a staging folder")
        replace_bars(rows, path, staging, counts)
        return counts
    _write_partitions(
        _counted(rows, counts), path, keys, "overwrite" if mode == "replace" else "append"
    )
    if mode == "replace":
        _drop_days_of_former_groups(rows, path)
    return counts


def _drop_days_of_former_groups(rows: DataFrame, path: str) -> None:
    """In the full layout, take away a written day's folder under any other group of its ticker.

    Only tickers with folders under several groups are looked at, which are few.
    """
    spark = rows.sparkSession
    at: dict[str, list[str]] = {}
    for group in subfolders(spark, path):
        for ticker in subfolders(spark, f"{path}/{group}"):
            at.setdefault(ticker, []).append(group)
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    value = lambda folder: plain(folder.partition("=")[2])
    moved = {value(t): t for t, groups in at.items() if len(groups) > 1 and "=" in t}
    if not moved:
        return
    days = rows.where(F.col("ticker").isin(list(moved)) & F.col("date").isNotNull())
    for d in days.select("sector", "ticker", "year", "month", "day").distinct().collect():
        folder = moved[d["ticker"]]
        for group in at[folder]:
            if value(group) != d["sector"]:
                drop_folder(spark, f"{path}/{group}/{folder}/year={d['year']}/month={d['month']}/day={d['day']}")


def _counted(rows: DataFrame, counts: Observation) -> DataFrame:
    return rows.observe(
        counts, F.count(F.lit(1)).alias("rows"),
        F.approx_count_distinct("ticker").alias("entities"),
    )


def replace_bars(rows: DataFrame, path: str, staging: str, counts: Observation) -> None:
    """Merge new bars into the months they touch, in the compact layout.

    All groups of a touched month are merged, since an entity may have changed
    its group; other months are not read. The merged folders are first written
    to ``staging``, then moved over. If that second step is interrupted,
    calling again with the same ``staging`` finishes it without reading the
    half-replaced table; the counts are then those of the staged rows. A folder
    whose last row moved to another group is deleted at the end. Rows without a
    date are a month of their own.
    """
    spark = rows.sparkSession
    if not file_exists(spark, f"{staging}/_SUCCESS"):
        merged = _counted(rows, counts)
        if file_exists(spark, path):
            # At most twelve a year, so they can be part of the plan: the scan
            # of the stored bars is pruned to them.
            month = F.concat(F.col("year").cast("string"), F.col("month"))
            touched = [r[0] for r in rows.select(month).distinct().collect()]
            affected = month.isin([m for m in touched if m is not None])
            if None in touched:
                affected = affected | month.isNull()
            stored = spark.read.schema(PROCESSED_BARS).parquet(path)
            merged = dedupe_bars(stored.where(affected).select(*rows.columns).unionByName(merged))
        _write_partitions(merged, staging, LAYOUTS["compact"], "overwrite", dynamic=False)
        counts = None
    finish_replace(spark, path, staging, counts)


def finish_replace(spark: SparkSession, path: str, staging: str, counts: Observation | None = None) -> bool:
    """Move complete staged months over the table; False if there is no complete stage."""
    if not file_exists(spark, f"{staging}/_SUCCESS"):
        return False
    keys = LAYOUTS["compact"]
    staged = spark.read.schema(PROCESSED_BARS).parquet(staging)
    _write_partitions(staged if counts is None else _counted(staged, counts), path, keys, "overwrite")
    new = partition_folders(spark, staging, len(keys))
    months = {folder.split("/", 1)[1] for folder in new}
    for folder in partition_folders(spark, path, len(keys)) - new:
        if folder.split("/", 1)[1] in months:
            drop_folder(spark, f"{path}/{folder}")
    drop_folder(spark, staging)
    return True


def _write_partitions(
    df: DataFrame, path: str, keys: Sequence[str], mode: str, dynamic: bool = True
) -> None:
    within = [c for c in ("ticker", "date") if c not in keys]
    writer = _balanced(df, keys, within).write.mode(mode).option("compression", "snappy")
    if dynamic and mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def write_curated(
    view: DataFrame,
    path: str,
    by_month: bool = False,
    if_missing: bool = False,
    order: Sequence[Column] = (),
) -> None:
    """A curated table as snappy Parquet; replaces it unless ``if_missing``.

    ``by_month`` stores it in (year, month) folders. ``order`` sorts inside the
    files only, which costs no exchange and lets readers skip row groups.
    """
    if by_month:
        view = view.hint("rebalance", F.col("year"), F.col("month"))
        view = view.sortWithinPartitions("year", "month", *order)
    elif order:
        view = view.sortWithinPartitions(*order)
    writer = view.write.mode("ignore" if if_missing else "overwrite")
    if by_month:
        writer = writer.partitionBy("year", "month")
    writer.option("compression", "snappy").parquet(path)
