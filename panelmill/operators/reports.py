"""Counts and outcome reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.schemas import BARS, PanelSpec


def entity_counts(df: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    return df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("records"))


def ingest_report(
    requested: DataFrame,
    landed: DataFrame,
    errors: DataFrame | None = None,
    spec: PanelSpec = BARS,
) -> DataFrame:
    """Outcome per requested entity: ``success``, ``no_data`` or ``error``.

    ``errors`` may hold (entity, error) rows of a failed fetch. Every requested
    entity is reported once, so the three outcomes add up to the requests.
    """
    wanted = requested.select(spec.entity).distinct()
    found = landed.groupBy(spec.entity).agg(
        F.max(spec.date).alias(spec.date), F.count(F.lit(1)).alias("records")
    )
    report = wanted.join(found, spec.entity, "left")
    if errors is None:
        report = report.withColumn("error", F.lit(None).cast("string"))
    else:
        failed = errors.groupBy(spec.entity).agg(F.max("error").alias("error"))
        report = report.join(failed, spec.entity, "left")
    status = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("records").isNull(), "no_data")
        .otherwise("success")
    )
    return report.select(
        spec.entity, spec.date, F.coalesce("records", F.lit(0)).alias("records"),
        status.alias("status"), "error",
    )


def ingest_totals(report: DataFrame) -> DataFrame:
    """One row: requested = successful + without data + failed."""
    return report.agg(
        F.count(F.lit(1)).alias("requested"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "no_data", "error")],
    )
