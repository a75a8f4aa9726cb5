from panelmill.sinks.files import (
    write_curated, write_processed, write_raw, replace_bars,
)
from panelmill.sinks.tables import (
    bucket_count, create_row_views, publish, register_partitioned, upsert_master, write_bucketed,
)

__all__ = [
    "bucket_count", "create_row_views", "publish", "register_partitioned", "replace_bars", "upsert_master", "write_bucketed",
    "write_curated", "write_processed", "write_raw",
]
