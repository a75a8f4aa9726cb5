"""Catalog tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from panelmill.durable import folder_bytes, partition_folders
from panelmill.operators.rows import upsert_by_key
from panelmill.plans import lookups
from panelmill.schemas import BARS, PROCESSED_BARS, PanelSpec
from panelmill.sinks import snapshots
from panelmill.sinks.files import LAYOUTS

log = logging.getLogger(__name__)

BUCKET_BYTES = 512 * 1024 * 1024


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def register_partitioned(
    spark: SparkSession, name: str, path: str, layout: str = "compact", evolve: bool = False
) -> list[str]:
    """Declare stored bars as a table and pick up its new partitions.

    Safe to repeat: later calls look for folders that the table does not know
    yet. A partition whose folder has vanished is logged and stays in the table, where it has no rows (see
    ``vanished_partitions``). The schema is stated, so padded months stay text. ``evolve`` also looks into
    the files of the new folders for columns the table lacks and adds them; files without such a
    column read as null. Returns the added columns.
    """
    keys = LAYOUTS[layout]
    data = [f for f in PROCESSED_BARS if f.name not in keys]
    parts = [f for f in PROCESSED_BARS if f.name in keys]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*data, *parts])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'"
    )
    listed, known = partition_folders(spark, path, len(keys)), _known_partitions(spark, name)
    if lost := known - listed:
        log.warning("table %s: %d partitions without a folder, for example %s", name, len(lost), min(lost))
    fresh = sorted(listed - known)
    added = []
    if evolve and fresh:
        have = set(spark.table(name).columns)
        reader = spark.read.option("mergeSchema", True).option("basePath", path)
        added = [f for f in reader.parquet(*[f"{path}/{f}" for f in fresh]).schema if f.name not in have]
        if added:
            news = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {_quoted(name)} ADD COLUMNS ({news})")
    if fresh:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)} ADD PARTITIONS")
    spark.catalog.refreshTable(name)
    return [f.name for f in added]


def _known_partitions(spark: SparkSession, name: str) -> set[str]:
    return {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {_quoted(name)}").collect()}


def vanished_partitions(spark: SparkSession, name: str, path: str, layout: str = "compact") -> list[str]:
    """Partitions of a registered table whose folders are gone."""
    return sorted(_known_partitions(spark, name) - partition_folders(spark, path, len(LAYOUTS[layout])))


def create_row_views(
    spark: SparkSession, table: str, since_year: int, sector: str
) -> tuple[str, str]:
    """Create or replace the two row views over a registered table of bars."""
    enriched, chosen = "stock_data_enriched", f"{sector.lower()}_sector_stocks"
    for view, frame in (
        (enriched, lookups.enriched_view(spark.table(table), since_year)),
        (chosen, lookups.sector_view(spark.table(table), sector, since_year)),
    ):
        rows = f"year >= {int(since_year)}"
        if view == chosen:
            literal = sector.replace("'", "\\'")
            rows += f" AND sector = '{literal}'"
        columns = ", ".join(frame.columns)
        spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(view)} AS "
            f"SELECT {columns} FROM {_quoted(table)} WHERE {rows}"
        )
    return enriched, chosen


def publish(
    view: DataFrame,
    name: str,
    root: str,
    by_month: bool = False,
    order: Sequence[Column] = (),
    keep: int = 2,
) -> str:
    """Store a curated table as a new version and make it the current one.

    Readers see the old rows until the new ones are complete, and a failed
    build leaves the table as it was. The name is a catalog view over the
    versions (see ``snapshots``). Returns the new folder. The last ``keep``
    versions stay, for readers still using the previous one.
    """
    spark = view.sparkSession
    path, months = snapshots.write_version(view, name, root, by_month, order=order)
    snapshots.commit(spark, root, {name: months}, whole=[name], keep=keep)
    snapshots.show_under_name(spark, root, name, view.dtypes, by_month)
    return path


def write_bucketed(
    bars: DataFrame, name: str, root: str, buckets: int | None = None, spec: PanelSpec = BARS
) -> DataFrame:
    """Bars as a table bucketed and sorted by entity, in a new folder.

    Every view along a series then reads them without an exchange, so one
    shuffle here serves all of them. A bucket holds whole series, and a series
    is bounded by its days. The default is one bucket per shuffle partition;
    see ``bucket_count`` for stored bars.
    """
    spark = bars.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        bars.repartition(buckets, spec.entity)
        .write.mode("overwrite").bucketBy(buckets, spec.entity)
        .sortBy(spec.entity, spec.date)
        .option("compression", "snappy")
        .option("path", f"{root.rstrip('/')}/{name}/{snapshots.new_version()}")
        .saveAsTable(name)
    )
    return spark.table(name)


def bucket_count(spark: SparkSession, path: str, target: int = BUCKET_BYTES) -> int:
    """Buckets of about ``target`` bytes for the bars stored at ``path``."""
    wanted = folder_bytes(spark, path) // target + 1
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(wanted, least), most)


def upsert_master(
    spark: SparkSession, name: str, root: str, new: DataFrame, now: Column, key: str = "ticker"
) -> str:
    """Apply changes to the stored master and make the result its current version."""
    merged = upsert_by_key(spark.table(name), new, key, now)
    return publish(merged, name, root)
