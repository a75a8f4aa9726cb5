"""One label per bar from repeated or historical masters, and tables whose folders come and go."""

import datetime as dt
import logging
import shutil

from pyspark.sql import functions as F

from panelmill.operators import enrich
from panelmill.plans.load import load_batch
from panelmill.sinks import register_partitioned, write_processed
from panelmill.sinks.tables import vanished_partitions
from panelmill.sources import HistoryMaster, SnapshotMaster, read_bars, read_master, read_raw
from test_sources_sinks import land, rows


def bar(ticker, day):
    return f"{ticker},{day},1,2,0.5,1.5,3,2024-03-01T00:00:00"


def test_repeated_exports_multiply_nothing(spark, tmp_path):
    export = tmp_path / "export"
    export.mkdir()
    (export / "1.json").write_text(
        '{"ticker": "AAA", "sector": "Old", "updated_at": "2024-01-01T00:00:00"}\n{"ticker": "BBB", "sector": "S"}\n')
    (export / "2.json").write_text(
        '{"ticker": "AAA", "sector": "New", "updated_at": "2024-02-01T00:00:00"}\n{"ticker": "BBB", "sector": "S"}\n')
    master = read_master(spark, SnapshotMaster(str(export)))
    assert rows(master, "ticker", "sector") == [("AAA", "New"), ("BBB", "S")]
    land(tmp_path / "raw", "a.csv", bar("AAA", "2024-01-02"), bar("BBB", "2024-01-02"), bar("CCC", "2024-01-02"))
    raw = read_raw(spark, str(tmp_path / "raw"))
    twice = SnapshotMaster(str(export)).load(spark)  # as it is, with several rows of a ticker
    for labels in (master, twice):
        assert rows(enrich(raw, labels), "ticker", "sector") == [("AAA", "New"), ("BBB", "S"), ("CCC", "Unknown")]


def test_history_gives_each_bar_the_label_of_its_day(spark, tmp_path):
    history = tmp_path / "history"
    history.mkdir()
    lines = [("AAA", "First", "2024-01-10"), ("AAA", "Second", "2024-02-01"), ("AAA", "Second", "2024-02-01"), ("BBB", "Always", None)]
    (history / "1.json").write_text("".join(
        '{"ticker": "%s", "sector": "%s"%s}\n' % (t, s, f', "valid_from": "{d}"' if d else "") for t, s, d in lines))
    days = ["2024-01-09", "2024-01-10", "2024-01-31", "2024-02-01", "2024-03-01"]
    land(tmp_path / "raw", "a.csv", *[bar("AAA", d) for d in days], bar("BBB", "2024-01-09"), bar("CCC", "2024-01-09"))
    path = str(tmp_path / "bars")
    load_batch(spark, str(tmp_path / "raw"), path, HistoryMaster(str(history)), mode="replace")
    got = read_bars(spark, path, unique=False)
    assert got.columns == enrich(read_raw(spark, str(tmp_path / "raw")), None).columns
    assert rows(got.where("ticker = 'AAA'"), "date", "sector") == [
        (dt.date.fromisoformat(d), s) for d, s in zip(days, ["Unknown", "First", "First", "Second", "Second"])]
    assert rows(got.where("ticker <> 'AAA'"), "ticker", "sector") == [("BBB", "Always"), ("CCC", "Unknown")]


def test_vanished_partitions_are_logged_and_stay(spark, tmp_path, caplog):
    land(tmp_path / "raw", "a.csv", bar("AAA", "2024-01-02"), bar("BBB", "2024-02-02"))
    path = str(tmp_path / "bars")
    write_processed(enrich(read_raw(spark, str(tmp_path / "raw")), None), path, "compact")
    assert register_partitioned(spark, "comes_and_goes", path) == []
    assert vanished_partitions(spark, "comes_and_goes", path) == []
    shutil.move(f"{path}/sector=Unknown/year=2024/month=01", tmp_path / "aside")
    with caplog.at_level(logging.WARNING):
        register_partitioned(spark, "comes_and_goes", path)
    assert "1 partitions without a folder" in caplog.text
    assert vanished_partitions(spark, "comes_and_goes", path) == ["sector=Unknown/year=2024/month=01"]
    assert spark.sql("SHOW PARTITIONS comes_and_goes").count() == 2
    shutil.move(tmp_path / "aside", f"{path}/sector=Unknown/year=2024/month=01")
    register_partitioned(spark, "comes_and_goes", path)
    assert vanished_partitions(spark, "comes_and_goes", path) == []
    assert rows(spark.table("comes_and_goes"), "ticker") == [("AAA",), ("BBB",)]


def test_new_columns_come_from_new_folders_only(spark, tmp_path):
    """Files of known folders are not opened again: here they are broken."""
    land(tmp_path / "raw", "a.csv", bar("AAA", "2024-01-02"))
    path = str(tmp_path / "bars")
    bars = enrich(read_raw(spark, str(tmp_path / "raw")), None)
    write_processed(bars, path, "full")
    register_partitioned(spark, "grows", path, "full", evolve=True)
    for file in (tmp_path / "bars").rglob("*.parquet"):
        file.write_bytes(b"broken")
    (bars.withColumns({"adjusted": F.lit(1.25), "ticker": F.lit("NEW")})
     .write.mode("append").partitionBy("sector", "ticker", "year", "month", "day").parquet(path))
    assert register_partitioned(spark, "grows", path, "full", evolve=True) == ["adjusted"]
    assert rows(spark.table("grows").where("ticker = 'NEW'"), "ticker", "adjusted") == [("NEW", 1.25)]


def test_rejects_are_stored_once(spark, tmp_path):
    from panelmill.plans.load import rejects_of

    land(tmp_path / "raw", "a.csv", "AAA,notadate,1,2,0.5,1.5,3,2024-01-06T00:00:00", bar("AAA", "2024-01-02"))
    path = str(tmp_path / "bars")
    for _ in range(2):
        assert load_batch(spark, str(tmp_path / "raw"), path, mode="replace")["rejected"] == 1
    assert spark.read.json(rejects_of(path)).count() == 1 and read_bars(spark, path, unique=False).count() == 1
