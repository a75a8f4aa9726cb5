"""Time the headline queries; prints one JSON line.

Every query runs in full into the no-op sink, so that all rows and columns are
computed and none are brought to the driver. The time of a query is the better
of two runs, after one untimed query that starts the session's threads.

The names with ``stored_`` run on processed bars that were written before, as
users have them, and so without deriving a panel; ``refresh_all`` rebuilds and
publishes the five default views from them, and ``split_ranking`` forces groups
apart. They are reported with the others but are not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelmill.contract import panels  # noqa: E402
from panelmill.contract.queries import QUERIES  # noqa: E402
from panelmill.operators import groups  # noqa: E402
from panelmill.plans import build  # noqa: E402
from panelmill.plans.refresh import refresh_all  # noqa: E402
from panelmill.sinks import write_processed  # noqa: E402
from panelmill.sources import read_bars  # noqa: E402

HEADLINE = [
    "sector_daily_summary", "ticker_monthly_summary", "sector_performance_ranking",
    "cross_sector_comparison", "volatility_analysis", "sector_performance_full",
    "cross_sector_full", "volatility_full", "daily_price_change", "bars_enriched",
    "dedupe_bars", "latest_ranking",
]


def stored_timings(spark: SparkSession, sf_dir: str, timed) -> dict[str, float]:
    """Views, the refresh and a split ranking over stored bars."""
    with tempfile.TemporaryDirectory(prefix="panelmill-bench-", ignore_cleanup_errors=True) as home:
        path = f"{home}/bars"
        spark.sparkContext.setCheckpointDir(f"{home}/checkpoints")
        write_processed(panels.bars(spark, sf_dir), path, "compact", "replace", f"{home}/stage")
        views = ("sector_daily_summary", "sector_performance_ranking", "volatility_analysis")
        bars = lambda: read_bars(spark, path, unique=False)
        seconds = {f"stored_{v}": timed(lambda v=v: build(v, bars())) for v in views}
        groups.TASK_BYTES, small = 0, groups.TASK_BYTES
        seconds["stored_split_ranking"] = timed(lambda: build("sector_performance_ranking", bars()))
        groups.TASK_BYTES = small
        seconds["refresh_all"] = timed(lambda: refresh_all(spark, path, f"{home}/curated", unique=True))
        return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="panelmill-warehouse-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE

    def timed(build) -> float:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            frame = build()
            if frame is not None:
                frame.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        return round(min(runs), 3)

    QUERIES["ticker_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {name: timed(lambda n=name: QUERIES[n](spark, sf_dir)) for name in only}
    total = round(sum(seconds.values()), 3)
    if only is HEADLINE:
        seconds |= stored_timings(spark, sf_dir, timed)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
