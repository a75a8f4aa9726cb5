"""Refresh of the months that changes reach, and one commit for all tables."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelmill import durable
from panelmill.contract import panels
from panelmill.plans import build, changes
from panelmill.plans.refresh import refresh_all
from panelmill.plans.registry import CURATED, DEFAULT_VIEWS
from panelmill.sinks import snapshots, write_processed
from panelmill.sources import read_bars

ALL = list(CURATED)


class Shop:
    """Stored bars with their curated tables."""

    def __init__(self, spark, home, bars, layout="compact"):
        self.spark, self.home, self.layout, self.steps = spark, home, layout, 0
        self.path, self.root = str(home / "bars"), str(home / "curated")
        self.load(bars)

    def load(self, bars, mode="replace"):
        self.steps += 1
        changes.log_changes(bars, self.path)
        write_processed(bars, self.path, self.layout, mode, str(self.home / f"stage{self.steps}"))

    def refresh(self, names=ALL, **options):
        report = refresh_all(self.spark, self.path, self.root, names, **options)
        return {r["view_name"]: r["status"] for r in report.collect()}

    def stored(self, name):
        return snapshots.read_current(self.spark, self.root, name)

    def differences(self, names=ALL):
        bars = read_bars(self.spark, self.path)
        out = {}
        for name in names:
            want = build(name, bars)
            cell = lambda c, k: F.round(c, 9) if k == "double" else F.col(c)  # noqa: E731  sums come in any order
            cells = [cell(c, k).alias(c) for c, k in want.dtypes]
            got = self.spark.table(name).select(*cells)
            want = want.select(*cells)
            n = got.exceptAll(want).count() + want.exceptAll(got).count()
            if n:
                out[name] = n
        return out


def later(bars, days=1):
    return bars.withColumn("fetched_at", F.col("fetched_at") + F.expr(f"INTERVAL {days} DAY"))


@pytest.fixture(scope="module")
def bars(spark, small):
    rows = panels.bars(spark, small)
    return spark.createDataFrame(rows.collect(), rows.schema)


@pytest.mark.parametrize("layout,mode", [("compact", "replace"), ("full", "append")])
def test_equals_a_full_rebuild(spark, tmp_path, bars, layout, mode):
    """Inserts, corrections, a changed group, a new entity, an old gap filled, and a row without a date."""
    few = bars.where("year = 2001 AND ticker <= 'T0000000006'")
    ticker, other = "T0000000001", "T0000000002"
    of = lambda t, *months: (few["ticker"] == t) & few["month"].isin(*months)
    gap = of(ticker, "03", "04")
    shop = Shop(spark, tmp_path, few.where(~gap), layout)
    assert set(shop.refresh().values()) == {"SUCCEEDED"}

    fixed = later(few.where(of(other, "02"))).withColumn("close", F.col("close") * 3)
    moved = later(few.where(of(ticker, "05"))).withColumn("sector", F.lit("Elsewhere"))
    new = few.where(of(ticker, "01")).withColumn("ticker", F.lit("NEW"))
    shop.load(few.where(gap).unionByName(fixed).unionByName(moved), mode)
    shop.load(new, mode)
    assert set(shop.refresh(incremental=True).values()) == {"SUCCEEDED"}
    assert shop.differences() == {}

    undated = few.where(few["ticker"] == other).limit(1).withColumns({
        "date": F.lit(None).cast("date"), "year": F.lit(None).cast("int"), "month": F.lit(None).cast("string"),
        "day": F.lit(None).cast("string")})
    shop.load(undated, mode)
    names = ["sector_daily_summary", "volatility_full", "cross_sector_full"]
    assert set(shop.refresh(names, incremental=True).values()) == {"SUCCEEDED"} and shop.differences(names) == {}
    assert set(shop.refresh(names, incremental=True).values()) == {"UNCHANGED"}
    assert len(changes.batches(spark, shop.path)) == 1  # the other tables have not taken it in


def test_months_that_no_change_reaches_are_not_read(spark, tmp_path, bars):
    """Their files are broken between two refreshes: whoever reads them fails."""
    shop = Shop(spark, tmp_path, bars)
    shop.refresh(DEFAULT_VIEWS)
    before = snapshots.load(spark, shop.root).months
    assert changes.batches(spark, shop.path) == []
    shop.load(later(bars.where("year = 1998 AND month = '07'").limit(3)).withColumn("close", F.col("close") + 1))
    read = set()
    for file in Path(shop.path).rglob("*.parquet"):
        year, month = (int(next(p for p in file.parts if p.startswith(k)).partition("=")[2]) for k in ("year=", "month="))
        if not 199701 <= year * 100 + month <= 199912:
            file.write_bytes(b"broken")
        else:
            read.add((year, month))
    assert set(shop.refresh(DEFAULT_VIEWS, incremental=True).values()) == {"SUCCEEDED"}
    after = snapshots.load(spark, shop.root).months
    for name in DEFAULT_VIEWS:
        changed = {k for k in after[name] if after[name][k] != before[name].get(k)}
        assert (1998, 7) in changed and changed <= {k for k in read if k >= (1998, 7)}, (name, changed)
    assert {k for k in after["ticker_monthly_summary"] if after["ticker_monthly_summary"][k] != before["ticker_monthly_summary"][k]} == {(1998, 7)}


def test_all_names_change_together(spark, tmp_path, bars, monkeypatch):
    """A run that dies at any step leaves every table as it was."""
    from panelmill.plans import refresh

    some = bars.where("year = 2001")
    shop = Shop(spark, tmp_path, some)
    shop.refresh(DEFAULT_VIEWS)
    old = {n: spark.table(n).count() for n in DEFAULT_VIEWS}
    shop.load(some.withColumn("ticker", F.concat(F.lit("X"), "ticker")))

    def die(*_, **__):
        raise KeyboardInterrupt("lost")

    for module, step in ((snapshots, "write_text"), (snapshots, "move_into_place"), (refresh.snapshots, "commit")):
        with monkeypatch.context() as patch:
            patch.setattr(module, step, die)
            with pytest.raises(KeyboardInterrupt):
                shop.refresh(DEFAULT_VIEWS, incremental=True)
        assert {n: spark.table(n).count() for n in DEFAULT_VIEWS} == old
    shop.refresh(DEFAULT_VIEWS, incremental=True)
    assert shop.differences(DEFAULT_VIEWS) == {}
    assert all(spark.table(n).count() > old[n] for n in ("ticker_monthly_summary", "volatility_analysis"))


def test_a_failed_view_is_made_up_for(spark, tmp_path, bars, monkeypatch):
    from panelmill.plans import refresh

    shop = Shop(spark, tmp_path, bars.where("year = 2001"))
    names = ["sector_daily_summary", "volatility_analysis"]
    shop.refresh(names)
    shop.load(later(bars.where("year = 2001 AND month = '03'")).withColumn("close", F.col("close") * 2))
    real = refresh.build

    def broken(name, *args):
        if name == "volatility_analysis":
            raise RuntimeError("no")
        return real(name, *args)

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "build", broken)
        assert shop.refresh(names, incremental=True) == {"sector_daily_summary": "SUCCEEDED", "volatility_analysis": "FAILED"}
    assert set(shop.differences(names)) == {"volatility_analysis"}
    assert shop.refresh(names, incremental=True)["volatility_analysis"] == "SUCCEEDED"
    assert shop.differences(names) == {}


def test_months_by_rows(spark):
    """Reach and halo are counted in rows: 3 a month here, none in April."""
    per_month = spark.createDataFrame(
        [("a", 2024, m, 3) for m in (1, 2, 3, 5, 6, 7)] + [("b", 2024, m, 30) for m in range(1, 8)], "k string, y int, m int, n bigint")
    touched = spark.createDataFrame([("a", 2024, 2)], "k string, y int, m int")
    months = lambda xs: [(2024, m) for m in xs]
    assert changes.dirty_months(per_month, ["k"], touched, 1) == months([2, 3])
    assert changes.dirty_months(per_month, ["k"], touched, 4) == months([2, 3, 5])
    assert changes.dirty_months(per_month, ["k"], touched, 60) == months([2, 3, 5, 6, 7])
    only_a = per_month.where("k = 'a'")
    assert changes.needed_months(only_a, ["k"], months([6]), 3) == months([5, 6])
    assert changes.needed_months(only_a, ["k"], months([6]), 4) == months([3, 5, 6])
    assert changes.needed_months(per_month, ["k"], months([6]), 4) == months([3, 5, 6])


def test_commits_are_kept_apart(spark, tmp_path):
    root = str(tmp_path / "c")
    frame = lambda x: spark.createDataFrame([(x, dt.date(2024, 1, 1)), (x, None)], "x int, date date")
    for x in (1, 2, 3):
        _, months = snapshots.write_version(frame(x), "t", root, date="date")
        assert set(months) == {(2024, 1), (0, 0)}
        snapshots.commit(spark, root, {"t": months})
    assert snapshots.load(spark, root).number == 3
    assert {r["x"] for r in snapshots.read_current(spark, root, "t").collect()} == {3}
    snapshots.commit(spark, root, {"t": {(0, 0): None}})
    assert snapshots.read_current(spark, root, "t").count() == 1
    aside = str(tmp_path / "aside")
    durable.write_text(spark, aside, "late")
    with pytest.raises(FileExistsError):  # another run has taken the number
        durable.move_into_place(spark, aside, snapshots._file(root, snapshots.load(spark, root).number))
    assert snapshots.read_current(spark, root, "t").count() == 1
