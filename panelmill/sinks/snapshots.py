"""Snapshots: which stored version of each month of each table is current.

Tables lie in ``root/<name>/version=…/y=…/m=…`` (see ``home_of``). A commit is one small file beside
the root that names the current version of every month of every table. It
is written aside and renamed into place, so the tables of a refresh change
together, and a run that dies before the rename has changed nothing. Catalog
names are views that look up the newest commit when they are queried; a
month without changes keeps the version that an earlier refresh wrote.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.durable import drop_folder, file_names, move_into_place, read_text, subfolders, write_text

#: Year and month of rows without a date, and of tables without months.
NO_MONTH = (0, 0)
Month = tuple[int, int]


def commits_of(root: str) -> str:
    return f"{root.rstrip('/')}_commits"


def home_of(root: str, name: str) -> str:
    """A table's folder; tables without a catalog name, which start with an underscore, lie beside the root."""
    return f"{root.rstrip('/')}{'_counts' if name.startswith('_') else ''}/{name}"


@dataclass
class Snapshot:
    """The state of all tables: ``months[name][(y, m)]`` is a version, ``number`` that of the commit.

    ``marks[name]`` is the newest batch of changes that the table takes in.
    """

    number: int = 0
    months: dict[str, dict[Month, str]] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)

    def with_months(self, changes: dict[str, dict[Month, str | None]], whole: Iterable[str] = ()) -> Snapshot:
        """The next state; None takes a month away, and tables in ``whole`` keep no former months."""
        whole = set(whole)
        state = {name: {} if name in whole else dict(months) for name, months in self.months.items()}
        for name, months in changes.items():
            state.setdefault(name, {}).update(months)
        state = {name: {k: v for k, v in months.items() if v is not None} for name, months in state.items()}
        return Snapshot(self.number + 1, state, dict(self.marks))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = file_names(spark, commits_of(root))
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _file(root: str, number: int) -> str:
    return f"{commits_of(root)}/{number:012d}.json"


def load(spark: SparkSession, root: str, number: int | None = None) -> Snapshot:
    """The newest commit, or that with a number; an empty snapshot if there is none.

    A commit has a line for each month of each table, at most twelve a year.
    """
    numbers = _numbers(spark, root)
    if not numbers:
        return Snapshot()
    found = Snapshot(number or numbers[-1])
    for line in read_text(spark, _file(root, found.number)).splitlines():
        row = json.loads(line)
        if row["mark"] is not None:
            found.marks[row["mark"]] = row["version"]
        else:
            found.months.setdefault(row["view"], {})[row["y"], row["m"]] = row["version"]
    return found


def commit(
    spark: SparkSession, root: str, changes: dict[str, dict[Month, str | None]], whole: Iterable[str] = (),
    marks: dict[str, str | None] | None = None, keep: int = 2,
) -> Snapshot:
    """Make new versions of months current, all with one rename; returns the new snapshot.

    ``changes[name][(y, m)]`` is the new version of a month, or None where the
    month has no rows any more. Tables in ``whole`` keep none of their former
    months. Versions that the last ``keep`` commits do not name are deleted
    afterwards. A mark of None takes a table's mark away. Of two commits at a time the later one fails.
    """
    new = load(spark, root).with_months(changes, whole)
    new.marks = {name: batch for name, batch in (new.marks | (marks or {})).items() if batch is not None}
    line = lambda **row: json.dumps({"commit": new.number, "mark": None, "view": None, "y": 0, "m": 0} | row)
    lines = [
        line(view=name, y=y, m=m, version=version)
        for name in sorted(new.months) for (y, m), version in sorted(new.months[name].items())
    ] + [line(mark=name, version=batch) for name, batch in sorted({"": "", **new.marks}.items())]
    aside = f"{commits_of(root)}/_{uuid.uuid4().hex}"
    write_text(spark, aside, "\n".join(lines) + "\n")
    move_into_place(spark, aside, _file(root, new.number))
    _clean(spark, root, keep)
    return new


def _clean(spark: SparkSession, root: str, keep: int) -> None:
    numbers = _numbers(spark, root)
    used: dict[str, set[str]] = {}
    for number in numbers[-keep:]:
        for name, months in load(spark, root, number).months.items():
            used.setdefault(name, set()).update(months.values())
    for number in numbers[:-keep]:
        drop_folder(spark, _file(root, number))
    for name, versions in used.items():
        for folder in subfolders(spark, home_of(root, name)):
            if folder.startswith("version=") and folder.removeprefix("version=") not in versions:
                drop_folder(spark, f"{home_of(root, name)}/{folder}")


def new_version() -> str:
    """A name that sorts by time and is used by no other run."""
    return f"v{datetime.now(timezone.utc).strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:8]}"


def month_columns(df: DataFrame, by_month: bool = False, date: str | None = None) -> dict[str, Column]:
    """y and m of a row: from its columns year and month, from a date, or none."""
    if by_month:
        y, m = F.col("year").cast("int"), F.col("month").cast("int")
    elif date is not None and date in df.columns:
        y, m = F.year(date), F.month(date)
    else:
        y, m = F.lit(None), F.lit(None)
    return {"y": F.coalesce(y, F.lit(0)).cast("int"), "m": F.coalesce(m, F.lit(0)).cast("int")}


def write_version(
    view: DataFrame, name: str, root: str, by_month: bool = False, date: str | None = None, order: Sequence[Column] = (),
    only: Iterable[Month] | None = None,
) -> tuple[str, dict[Month, str]]:
    """Store rows as a new version, not yet current: its folder, and the months it holds.

    ``only`` restricts the rows to some months. ``order`` sorts inside the files.
    """
    rows = view.withColumns(month_columns(view, by_month, date))
    if only is not None:
        rows = rows.where((F.col("y") * 100 + F.col("m")).isin([y * 100 + m for y, m in only]))
    rows = rows.drop("year", "month") if by_month else rows
    if by_month or date is not None:
        rows = rows.hint("rebalance", F.col("y"), F.col("m")).sortWithinPartitions("y", "m", *order)
    elif order:
        rows = rows.sortWithinPartitions(*order)
    return write_months(rows, name, root, empty=only is None)


def write_months(rows: DataFrame, name: str, root: str, empty: bool = True) -> tuple[str, dict[Month, str]]:
    """Store rows that have y and m as a new version: its folder, and the months it holds.

    Without rows an ``empty`` month keeps the columns.
    """
    spark = rows.sparkSession
    version = new_version()
    path = f"{home_of(root, name)}/version={version}"
    rows.write.option("compression", "snappy").partitionBy("y", "m").parquet(path)
    months = {
        (int(y.partition("=")[2]), int(m.partition("=")[2])): version
        for y in subfolders(spark, path) if y.startswith("y=")
        for m in subfolders(spark, f"{path}/{y}") if m.startswith("m=")
    }
    if not months and empty:
        rows.drop("y", "m").limit(0).write.parquet(f"{path}/y=0/m=0")
        months = {NO_MONTH: version}
    return path, months


def read_current(spark: SparkSession, root: str, name: str, snapshot: Snapshot | None = None) -> DataFrame | None:
    """The table's current rows with y and m; None if no commit names it or it has no rows."""
    months = (snapshot or load(spark, root)).months.get(name)
    if not months:
        return None
    home = home_of(root, name)
    paths = [f"{home}/version={v}/y={y}/m={m}" for (y, m), v in sorted(months.items())]
    return spark.read.option("basePath", home).parquet(*paths).drop("version")


def show_under_name(
    spark: SparkSession, root: str, name: str, dtypes: Sequence[tuple[str, str]], by_month: bool = False
) -> None:
    """Make a catalog name a view of the current rows, whichever commit is newest when it is read.

    Filters on the year and month of a table stored by month prune its folders. Spark takes
    the columns from the oldest version, so where columns have changed the former versions do not stay.
    """
    home, columns = home_of(root, name), [c for c, _ in dtypes]
    stored = dict(spark.read.parquet(home).dtypes)
    if any(stored.get(c) != t for c, t in dtypes if not (by_month and c in ("year", "month"))):
        current = set(load(spark, root).months.get(name, {}).values())
        for folder in subfolders(spark, home):
            if folder.removeprefix("version=") not in current:
                drop_folder(spark, f"{home}/{folder}")
    derived = {
        "year": "CAST(nullif(s.y, 0) AS INT) AS year", "month": "lpad(CAST(nullif(s.m, 0) AS STRING), 2, '0') AS month"
    } if by_month else {}
    chosen = ", ".join(derived.get(c, f"s.`{c}`") for c in columns)
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    commits = commits_of(root)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {quoted}")  # of the time before there were commits
    spark.sql(f"""
        CREATE OR REPLACE VIEW {quoted} AS
        SELECT {chosen} FROM parquet.`{home}` s
        JOIN (SELECT y, m, version FROM json.`{commits}`
              WHERE view = '{name}' AND commit = (SELECT max(commit) FROM json.`{commits}`)) c
        ON s.y = c.y AND s.m = c.m AND s.version = c.version""")
