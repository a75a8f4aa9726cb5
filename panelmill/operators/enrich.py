"""Raw bars to processed bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.functions import clean_group, date_parts, last_segment
from panelmill.schemas import BARS, PanelSpec

BATCH_SOURCE = "batch_processing"


LABELS = ("exchange", "country")


def current_labels(master: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """One row per entity, or per entity and ``valid_from``: that with the latest ``updated_at``, if the master tells it.

    The aggregate also groups by the key's length, which changes nothing but
    leaves the join an exchange of its own, and only such an exchange is split by adaptive
    execution where an entity is hot.
    """
    keys = [spec.entity, *[c for c in ("valid_from",) if c in master.columns]]
    first = [c for c in ("updated_at",) if c in master.columns]
    row = F.struct(*first, spec.group, *LABELS)
    best = master.groupBy(*keys, F.length(F.col(spec.entity).cast("string")).alias("_length")).agg(F.max(row).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in (spec.group, *LABELS)])


def with_master(bars: DataFrame, master: DataFrame | None, spec: PanelSpec = BARS) -> DataFrame:
    """Left join of the master's group, exchange and country; every bar is kept once.

    Several master rows of one entity, as in repeated exports, count as one: the latest. A
    master with a date column ``valid_from`` tells labels over time: a bar gets those that
    were valid on its date, and the unknown group before the first.

    The master grows with the number of entities, so no broadcast is forced:
    Spark broadcasts it only while its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond.
    Without a master every bar gets the unknown group and null labels, by the
    same join against an empty table.
    """
    if master is None:
        text = [T.StructField(c, T.StringType()) for c in (spec.group, *LABELS)]
        master = bars.sparkSession.createDataFrame(
            [], T.StructType([bars.schema[spec.entity], *text])
        )
    labels = current_labels(master, spec)
    if "valid_from" in labels.columns:
        bars = _as_of(bars, labels, spec)
    else:
        bars = bars.join(labels, spec.entity, "left")
    return bars.withColumn(spec.group, clean_group(F.col(spec.group)))


def _as_of(bars: DataFrame, labels: DataFrame, spec: PanelSpec) -> DataFrame:
    """The labels of the period that a bar's date lies in; the periods of an entity do not overlap."""
    later = Window.partitionBy(spec.entity).orderBy("valid_from")  # a row for each change of labels
    periods = labels.withColumn("_until", F.lead("valid_from").over(later)).withColumnRenamed(spec.entity, "_entity")
    inside = (
        (F.col(spec.entity) == F.col("_entity"))
        & (F.col("valid_from").isNull() | (F.col(spec.date) >= F.col("valid_from")))
        & (F.col("_until").isNull() | (F.col(spec.date) < F.col("_until")))
    )
    return bars.join(periods, inside, "left").drop("_entity", "valid_from", "_until")


def enrich(
    raw: DataFrame,
    master: DataFrame | None,
    spec: PanelSpec = BARS,
    source_path: str | None = None,
) -> DataFrame:
    """Processed bars in their fixed column order.

    ``source_path`` names the column that holds each row's file path; without
    it the rows are marked as a batch load.
    """
    source = last_segment(F.col(source_path)) if source_path else F.lit(BATCH_SOURCE)
    if "source_file" in raw.columns:
        source = F.coalesce(F.col("source_file"), source)
    fetched = F.col("fetched_at") if "fetched_at" in raw.columns else F.lit(None)
    bars = (
        date_parts(raw, spec.date)
        .withColumns({
            "source_file": source,
            "fetched_at": fetched.cast("timestamp"),
            "ingested_at": F.current_timestamp(),
        })
    )
    bars = with_master(bars, master, spec)
    numbers = {spec.open: "double", spec.high: "double", spec.low: "double",
               spec.close: "double", spec.volume: "bigint"}
    order = [spec.group, spec.entity, "year", "month", "day", spec.date,
             *numbers, "exchange", "country", "ingested_at", "source_file", "fetched_at"]
    return bars.select(*[
        F.col(c).cast(numbers[c]).alias(c) if c in numbers else F.col(c) for c in order
    ])

