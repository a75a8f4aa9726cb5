"""New files through the stream, and the rebuild of the views."""

import pytest
from pyspark.sql import functions as F

from panelmill.contract import panels
from panelmill.plans import build
from panelmill.plans.refresh import refresh_all
from panelmill.plans.registry import CURATED, DEFAULT_VIEWS, ordered
from panelmill.sinks import write_processed
from panelmill.sources import SeedMaster, read_bars
from panelmill.streaming import run_stream
from test_sources_sinks import SEED, land, rows


class Lake:
    def __init__(self, spark, home, layout):
        self.spark, self.home, self.layout = spark, home, layout
        (home / "seed.json").write_text(SEED)
        (home / "raw").mkdir()
        self.processed = str(home / "processed")

    def land(self, folder, name, *lines):
        return land(self.home / "raw" / folder, name, *lines)

    def run(self, **options):
        return run_stream(
            self.spark, str(self.home / "raw"), self.processed, str(self.home / "check"),
            master=SeedMaster(str(self.home / "seed.json")), layout=self.layout, **options)

    def stored(self):
        return read_bars(self.spark, self.processed, unique=False)


@pytest.fixture(params=["full", "compact"])
def lake(request, spark, tmp_path):
    return Lake(spark, tmp_path, request.param)


def bar(ticker, day, close, fetched="2024-03-01T00:00:00"):
    return f"{ticker},{day},{close},{close},{close},{close},100,{fetched}"


def test_each_file_once_and_corrections_replace(lake):
    lake.land("AAA/2024/01/02", "AAA_2024-01-02.csv", bar("AAA", "2024-01-02", 10))
    lake.land("x", "many days.csv", bar("AAA", "2024-01-03", 11), bar("BBB", "2024-02-05", 5))
    (lake.home / "raw" / "readme.txt").write_text("no bars here")
    lake.run()
    first = [("AAA", "Fine_Arts", "01", 10.0), ("AAA", "Fine_Arts", "01", 11.0),
             ("BBB", "Tech", "02", 5.0)]
    cols = ("ticker", "sector", "month", "close")
    assert rows(lake.stored(), *cols) == first
    names = {r[0] for r in lake.stored().select("source_file").collect()}
    assert "AAA_2024-01-02.csv" in names

    lake.run()
    assert rows(lake.stored(), *cols) == first

    # The same content under a new name changes nothing, a correction replaces.
    lake.land("copy", "again.csv", bar("AAA", "2024-01-02", 10))
    lake.land("fix", "fix.csv", bar("BBB", "2024-02-05", 6, "2024-03-09T00:00:00"))
    lake.run()
    assert rows(lake.stored(), *cols) == [*first[:2], ("BBB", "Tech", "02", 6.0)]


def test_backlog_in_small_batches(lake):
    for day in range(1, 6):
        lake.land("b", f"{day}.csv", bar("AAA", f"2024-01-0{day}", day))
    lake.run(max_files=2)
    assert lake.stored().count() == 5


def test_repeated_batch_after_a_failure(lake, monkeypatch):
    """The batch stores its rows, then fails before it is marked done."""
    from panelmill.streaming import ingest

    lake.land("a", "a.csv", bar("AAA", "2024-01-02", 10), bar("BBB", "2024-01-02", 3))
    real = ingest.write_processed

    def then_fail(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost after the write")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "write_processed", then_fail)
        with pytest.raises(Exception, match="lost after the write"):
            lake.run()
    lake.run()
    assert rows(lake.stored(), "ticker", "close") == [("AAA", 10.0), ("BBB", 3.0)]


def test_run_refreshes_views_once(spark, tmp_path):
    lake = Lake(spark, tmp_path, "compact")
    for i, close in enumerate([100, 110, 99]):
        lake.land("a", f"{i}.csv", bar("AAA", f"2024-01-0{i + 1}", close))
    views = ["sector_daily_summary", "volatility_analysis"]
    reports = lake.run(curated=str(tmp_path / "curated"), views=views, max_files=1)
    assert [r.count() for r in reports] == [2]
    assert {r["status"] for r in reports[0].collect()} == {"SUCCEEDED"}
    assert spark.table("volatility_analysis").first()["max_drawdown_pct"] == 10.0
    assert lake.run(curated=str(tmp_path / "curated"), views=views) == []


def test_failed_refresh_is_made_up_for(spark, tmp_path, monkeypatch):
    from panelmill.streaming import ingest

    lake = Lake(spark, tmp_path, "compact")
    lake.land("a", "a.csv", bar("AAA", "2024-01-02", 10))
    wanted = dict(curated=str(tmp_path / "curated"), views=["sector_daily_summary"])

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "refresh_all", lost)
        with pytest.raises(RuntimeError):
            lake.run(**wanted)
    assert [r.first()["status"] for r in lake.run(**wanted)] == ["SUCCEEDED"]
    assert lake.run(**wanted) == []


def test_refresh_equals_direct_views(spark, small, tmp_path):
    bars = panels.bars(spark, small)
    write_processed(bars, str(tmp_path / "bars"), "compact", "replace", str(tmp_path / "s"))
    report = refresh_all(
        spark, str(tmp_path / "bars"), str(tmp_path / "out"), [*DEFAULT_VIEWS, "volatility_full"])
    assert rows(report, "view_name", "status") == sorted(
        (n, "SUCCEEDED") for n in [*DEFAULT_VIEWS, "volatility_full"])
    for name in ("ticker_monthly_summary", "sector_performance_ranking", "volatility_analysis"):
        stored, direct = spark.table(name), build(name, bars)
        assert stored.count() == direct.count()
        assert stored.select(*direct.columns).exceptAll(direct).isEmpty(), name
    assert dict(spark.table("volatility_full").dtypes)["month"] == "string"
    # The shared copy of the bars is gone, and so are all but two old versions.
    assert {p.name for p in (tmp_path / "out").iterdir()} == {*DEFAULT_VIEWS, "volatility_full"}
    for _ in range(3):
        refresh_all(spark, bars, str(tmp_path / "out"), ["sector_daily_summary"])
    assert len(list((tmp_path / "out" / "sector_daily_summary").iterdir())) == 2
    assert spark.table("sector_daily_summary").count() == build("sector_daily_summary", bars).count()


def test_one_failing_view_does_not_stop_the_rest(spark, small, tmp_path):
    def broken(bars, spec):
        return bars.select("no_such_column")

    report = refresh_all(
        spark, panels.bars(spark, small), str(tmp_path),
        ["broken", "sector_daily_summary", "unknown_name"], builders={"broken": broken})
    got = {r["view_name"]: r for r in report.collect()}
    assert got["sector_daily_summary"]["status"] == "SUCCEEDED"
    assert got["broken"]["status"] == "FAILED" and "no_such_column" in got["broken"]["error"]
    assert got["unknown_name"]["status"] == "FAILED"
    totals = report.groupBy("status").count()
    assert rows(totals, "status", "count") == [("FAILED", 2), ("SUCCEEDED", 1)]


def test_display_order(spark, small):
    bars = panels.bars(spark, small)
    for name in ("sector_daily_summary", "cross_sector_comparison"):
        top = ordered(name, build(name, bars)).limit(2).collect()
        assert top[0]["date"] == bars.agg(F.max("date")).first()[0]
        assert top[0]["date"] >= top[1]["date"]
    assert set(DEFAULT_VIEWS) <= set(CURATED)
