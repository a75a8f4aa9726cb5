"""Building the curated tables, in full or where bars have changed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelmill.durable import drop_folder
from panelmill.plans import changes
from panelmill.plans.registry import CURATED, DEFAULT_VIEWS, build, sort_columns
from panelmill.schemas import BARS, PanelSpec
from panelmill.sinks import snapshots
from panelmill.sinks.tables import bucket_count, write_bucketed
from panelmill.sources.processed import read_bars

REPORT = T.StructType([
    T.StructField("view_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("error", T.StringType()),
])

#: Rows per month of each series and group: tables of the snapshot without a catalog name.
COUNTS = {"series": "_series_months", "group": "_group_months"}


def refresh_all(
    spark: SparkSession,
    bars: DataFrame | str,
    root: str,
    names: Iterable[str] = DEFAULT_VIEWS,
    spec: PanelSpec = BARS,
    builders: dict[str, Callable[..., DataFrame]] | None = None,
    unique: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """Build the views and make them current together; one report row each.

    A view that fails is reported and does not stop the others. ``bars`` is a
    frame, or the path of stored bars: these are then bucketed by entity once,
    for all views, in a table that lasts as long as the refresh, and made unique
    on the way unless ``unique`` says that they are, as bars written in replace
    mode only.

    ``incremental`` builds only the months that loads since the last refresh
    reach, from the months which that takes; the result equals that of a full refresh. Views that
    were never built from these bars are built in full, and so are ``builders``.
    """
    builders, names = builders or {}, list(names)
    if not isinstance(bars, str):
        return _finish(spark, root, [_rebuild(bars, n, root, spec, builders) for n in names])
    batches = changes.batches(spark, bars)
    known = snapshots.load(spark, root)
    if incremental:
        usual = [n for n in names if n in CURATED and n not in builders and n in known.marks]
        if all(c in known.marks for c in COUNTS.values()) and len(usual) == len(names):
            return _refresh_changed(spark, bars, root, names, spec, unique, batches, known)
    scratch = f"bars_by_entity_{uuid.uuid4().hex[:8]}"
    source = write_bucketed(
        read_bars(spark, bars, not unique), scratch, root, bucket_count(spark, bars), spec)
    try:
        outcomes = [_rebuild(source, n, root, spec, builders) for n in names]
        counts = {
            COUNTS["series"]: snapshots.write_months(changes.series_months(source, spec), COUNTS["series"], root)[1],
            COUNTS["group"]: snapshots.write_months(changes.group_months(source, spec), COUNTS["group"], root)[1],
        }
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {scratch}")
        drop_folder(spark, f"{root.rstrip('/')}/{scratch}")
    report = _finish(spark, root, outcomes, counts, batches[-1] if batches else "")
    _forget(spark, bars, root, batches)
    return report


def _rebuild(source, name, root, spec, builders, months=None) -> dict:
    """Build one view, in some months or all, as a version that is not current yet."""
    try:
        view = builders[name](source, spec) if name in builders else build(name, source, spec)
        known = CURATED.get(name)
        by_month = known is not None and known.by_month
        date = known and {"date": spec.date}.get(known.month, known.month)
        order = sort_columns(name, spec) if known else ()
        path, found = snapshots.write_version(view, name, root, by_month, date, order, months)
        if months is not None:
            found = dict.fromkeys(months) | found
        return {"name": name, "path": path, "months": found, "dtypes": view.dtypes, "by_month": by_month}
    except Exception as error:  # noqa: BLE001  one broken view must not stop the rest
        return {"name": name, "error": str(error)}


def _finish(spark, root, outcomes, counts=None, mark=None, whole=True) -> DataFrame:
    """One commit for all views that were built, and their report."""
    built = [o for o in outcomes if "error" not in o]
    new = {o["name"]: o["months"] for o in built} | (counts or {})
    if new:
        # tables built from a frame have no mark: an incremental refresh builds them in full
        snapshots.commit(spark, root, new, list(new) if whole else (), dict.fromkeys(new, mark))
    for o in built:
        if whole or not spark.catalog.tableExists(o["name"]):
            snapshots.show_under_name(spark, root, o["name"], o["dtypes"], o["by_month"])
    return spark.createDataFrame(
        [(o["name"], "FAILED" if "error" in o else "SUCCEEDED", o.get("path"), o.get("error")) for o in outcomes], REPORT)


def _forget(spark, bars, root, batches) -> None:
    """Delete the batches that every table has taken in."""
    marks = snapshots.load(spark, root).marks
    done = min((v for k, v in marks.items() if k), default="")
    for batch in batches:
        if batch <= done:
            drop_folder(spark, f"{changes.changes_of(bars)}/{batch}")


def _refresh_changed(spark, bars, root, names, spec, unique, batches, known) -> DataFrame:
    """Build the months that changes reach.

    Changed bars are felt in their own month by the sums, up to ``reach`` rows later by what looks back
    along a series, in all rows of a (group, date) by ranks and shares, which lie in
    the same months, and up to ``reach`` dates later by what looks back along a group.
    """
    since = min(known.marks[n] for n in [*names, *COUNTS.values()])
    pending = [b for b in batches if b > since]
    if not pending:
        return spark.createDataFrame([(n, "UNCHANGED", None, None) for n in names], REPORT)
    touched = spark.read.parquet(*[f"{changes.changes_of(bars)}/{b}" for b in pending])
    touched = touched.withColumns(snapshots.month_columns(touched, date="date")).drop("date").distinct()
    own = sorted((r["y"], r["m"]) for r in touched.select("y", "m").distinct().collect())
    # the counts first: they tell how far the others reach
    fresh = read_bars(spark, bars, not unique, own)
    counts = {}
    for along, rows in (("series", changes.series_months(fresh, spec)), ("group", changes.group_months(fresh, spec))):
        _, found = snapshots.write_months(rows, COUNTS[along], root, empty=False)
        counts[COUNTS[along]] = dict.fromkeys(own) | found
    state = known.with_months(counts)
    keys = {"series": spec.series_keys, "group": [spec.group]}
    per_month = {a: snapshots.read_current(spark, root, COUNTS[a], state) for a in COUNTS}
    plans: dict[tuple[str, int], tuple[list, list]] = {}
    outcomes = []
    for name in names:
        along, reach = CURATED[name].along, CURATED[name].reach
        if (along, reach) not in plans:
            build_months = own if reach == 0 else changes.dirty_months(per_month[along], keys[along], touched, reach)
            read = own if reach == 0 else changes.needed_months(per_month[along], keys[along], build_months, reach)
            plans[along, reach] = build_months, read
        months, read = plans[along, reach]
        outcomes.append(_rebuild(read_bars(spark, bars, not unique, read), name, root, spec, {}, months))
    report = _finish(spark, root, outcomes, counts, pending[-1], whole=False)
    _forget(spark, bars, root, batches)
    return report
