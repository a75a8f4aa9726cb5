"""New raw files to processed bars to refreshed views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from panelmill.durable import drop_folder, file_exists, leave_mark
from panelmill.operators import enrich
from panelmill.plans.changes import log_changes
from panelmill.plans.load import write_rejects
from panelmill.plans.refresh import refresh_all
from panelmill.plans.registry import DEFAULT_VIEWS
from panelmill.sinks.files import write_processed
from panelmill.sources.master import MasterSource, read_master
from panelmill.sources.raw import SOURCE_PATH, accepted, stream_raw


def run_stream(
    spark: SparkSession,
    raw: str,
    processed: str,
    checkpoint: str,
    master: MasterSource | DataFrame | None = None,
    curated: str | None = None,
    layout: str = "compact",
    views: Iterable[str] = DEFAULT_VIEWS,
    max_files: int | None = None,
    unique: bool = False,
) -> list[DataFrame]:
    """Take in every file that arrived since the last run, then stop.

    The checkpoint remembers the files, and each micro-batch replaces the bars
    it brings: a batch that is repeated after a failure stores the same rows.
    The views are refreshed once at the end of a run that brought any file, in the months that
    the new bars reach, and their reports returned; if that fails, the next run makes up for it. The
    master is read anew for every batch. ``unique`` says that the bars were
    only ever written in replace mode, as here, which spares the refresh a pass.
    """
    pending = f"{checkpoint.rstrip('/')}/refresh_pending"

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        bars = enrich(accepted(batch), read_master(session, master), source_path=SOURCE_PATH)
        staging = f"{checkpoint.rstrip('/')}/staging/{batch_id}"
        leave_mark(session, pending)
        log_changes(bars, processed)
        write_processed(bars, processed, layout, "replace", staging)
        write_rejects(batch, processed)

    query = (
        stream_raw(spark, raw, max_files)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if curated is None or not file_exists(spark, pending):
        return []
    report = refresh_all(spark, processed, curated, views, unique=unique, incremental=True)
    if report.where("status = 'FAILED'").isEmpty():
        drop_folder(spark, pending)
    return [report]
