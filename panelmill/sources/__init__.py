from panelmill.sources.master import HistoryMaster, JdbcMaster, SeedMaster, SnapshotMaster, read_master
from panelmill.sources.processed import read_bars
from panelmill.sources.raw import SOURCE_PATH, read_raw, stream_raw

__all__ = [
    "HistoryMaster", "JdbcMaster", "SOURCE_PATH", "SeedMaster", "SnapshotMaster", "read_bars", "read_master",
    "read_raw", "stream_raw",
]
