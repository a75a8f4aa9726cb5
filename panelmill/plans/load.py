"""One batch from raw files to stored bars."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelmill.functions.dates import previous_day
from panelmill.operators import enrich
from panelmill.plans.changes import log_changes
from panelmill.sinks.files import finish_replace, write_processed
from panelmill.sources.master import MasterSource, read_master
from panelmill.sources.raw import SOURCE_PATH, accepted, read_lines, rejected


def stage_of(processed: str) -> str:
    """Where a replacing load keeps its merged months: beside the table, so that a later run finds them."""
    return f"{processed.rstrip('/')}_stage"


def rejects_of(processed: str) -> str:
    return f"{processed.rstrip('/')}_rejects"


def write_rejects(lines: DataFrame, processed: str) -> int:
    """Store the lines that do not parse beside the table, in a folder for each source file; how many there were.

    The folder of a file is replaced, so a file that is loaded again leaves its rejects once.
    """
    counts = Observation()
    bad = rejected(lines).observe(counts, F.count(F.lit(1)).alias("rejected"))
    writer = bad.hint("rebalance", F.col("source_file")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("source_file").json(rejects_of(processed))
    return observed(counts, "rejected")["rejected"]


def observed(counts: Observation, *names: str) -> dict[str, int]:
    """What a write counted; zeros if its rows turned out to be none, as nothing is observed then."""
    try:
        return dict(counts.get)
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def load_batch(
    spark: SparkSession,
    raw: str,
    processed: str,
    master: MasterSource | DataFrame | None = None,
    layout: str = "compact",
    mode: str = "append",
    require_master: bool = False,
    day: str | None = None,
) -> dict[str, int]:
    """Read all raw files below a folder, or one file, and store them.

    ``day`` takes the bars of one date only, ``yesterday`` that before the
    session's current date. ``require_master`` fails without a master instead
    of going on with unknown groups.

    Returns the rows and (approximate) entities written, counted by the write,
    and the lines rejected, which go to a folder beside the table. Which bars are new or changed is
    stored first, for the next refresh. A replacing
    load that was cut off while it moved its months is finished first.
    """
    finish_replace(spark, processed, stage_of(processed))
    lines = read_lines(spark, raw)
    rows = accepted(lines)
    if day is not None:
        rows = rows.where(F.col("date") == (previous_day() if day == "yesterday" else F.lit(day).cast("date")))
    labels = read_master(spark, master, required=require_master)
    bars = enrich(rows, labels, source_path=SOURCE_PATH)
    log_changes(bars, processed)
    written = write_processed(bars, processed, layout, mode, stage_of(processed))
    return {**observed(written, "rows", "entities"), "rejected": write_rejects(lines, processed)}
