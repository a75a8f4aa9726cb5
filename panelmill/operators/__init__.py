from panelmill.operators.enrich import enrich, with_master
from panelmill.operators.groups import with_group_standing
from panelmill.operators.reports import entity_counts, ingest_report, ingest_totals
from panelmill.operators.rows import dedupe_bars, latest_per_entity, upsert_by_key
from panelmill.operators.series import (
    rolling, series_window, with_previous, with_rolling, with_stitched_frames,
)

__all__ = [
    "dedupe_bars", "enrich", "entity_counts", "ingest_report", "ingest_totals",
    "latest_per_entity", "rolling", "series_window", "upsert_by_key",
    "with_group_standing", "with_master", "with_previous", "with_rolling", "with_stitched_frames",
]
