"""Files in, files out: layouts, replays and awkward inputs."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelmill.operators import enrich
from panelmill.schemas import PROCESSED_BARS
from panelmill.sinks import files
from panelmill.sinks import (
    bucket_count, create_row_views, publish, register_partitioned, upsert_master, write_bucketed, write_curated,
    write_processed, write_raw,
)
from panelmill.sources import (
    SOURCE_PATH, JdbcMaster, SeedMaster, SnapshotMaster, read_bars, read_master, read_raw,
)

HEADER = "ticker,date,open,high,low,close,volume,fetched_at\n"
BIG = 3_000_000_000

SEED = """[
 {"ticker": "AAA", "name": "A", "sector": "Fine Arts", "exchange": "X", "country": "US"},
 {"ticker": "BBB", "name": "B", "sector": "Tech", "exchange": "Y", "country": "JP",
  "is_active": true}
]"""


def land(folder: Path, name: str, *rows: str) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    file = folder / name
    file.write_text(HEADER + "".join(f"{r}\n" for r in rows))
    return file


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    land(root / "AAA" / "2024" / "01" / "05", "AAA_2024-01-05.csv",
         f"AAA,2024-01-05,1,2,0.5,1.5,{BIG},2024-01-06T00:00:00")
    land(root / "mixed", "two tickers.csv",
         "BBB,2024-02-01,10,11,9,10.5,7,2024-02-02T00:00:00",
         "CCC,2023-11-30,20,21,19,20.5,8,2024-02-02T00:00:00")
    (root / "mixed" / "notes.txt").write_text("not,a,bar\n")
    return root


@pytest.fixture
def master(spark, tmp_path):
    seed = tmp_path / "seed.json"
    seed.write_text(SEED)
    return read_master(spark, SeedMaster(str(seed)))


@pytest.fixture
def bars(spark, raw, master):
    return enrich(read_raw(spark, str(raw)), master, source_path=SOURCE_PATH)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_raw_scan_recurses_and_takes_only_csv(spark, raw):
    df = read_raw(spark, str(raw))
    assert rows(df, "ticker", "volume") == [("AAA", BIG), ("BBB", 7), ("CCC", 8)]
    assert dict(df.dtypes)["date"] == "date" and dict(df.dtypes)["volume"] == "bigint"


def test_one_named_file(spark, raw):
    df = read_raw(spark, str(raw / "mixed" / "two tickers.csv"))
    assert rows(df, "ticker") == [("BBB",), ("CCC",)]


def test_header_in_another_order_is_refused(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("date,ticker,open,high,low,close,volume,fetched_at\n"
                                      "2024-01-01,AAA,1,1,1,1,1,\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path)).collect()


def test_enriched_columns_and_labels(bars):
    assert bars.columns == PROCESSED_BARS.names
    got = rows(bars, "ticker", "sector", "year", "month", "day", "exchange", "source_file")
    assert [r[:5] for r in got] == [
        ("AAA", "Fine_Arts", 2024, "01", "05"), ("BBB", "Tech", 2024, "02", "01"),
        ("CCC", "Unknown", 2023, "11", "30")]
    assert [r[5] for r in got] == ["X", "Y", None]
    assert got[0][6] == "AAA_2024-01-05.csv"
    assert bars.where("ingested_at IS NULL").isEmpty()


def test_batch_load_without_path_is_marked(spark, raw, master):
    df = enrich(read_raw(spark, str(raw)), master)
    assert {r[0] for r in df.select("source_file").collect()} == {"batch_processing"}


def test_master_sources(spark, tmp_path, master):
    pages = tmp_path / "export"
    pages.mkdir()
    (pages / "1.json").write_text('{"ticker": "AAA", "sector": "S1"}\n')
    (pages / "2.json").write_text('{"ticker": "BBB", "sector": "S2"}\n')
    both = read_master(spark, SnapshotMaster(str(pages)))
    assert rows(both, "ticker", "sector") == [("AAA", "S1"), ("BBB", "S2")]
    assert master.columns == ["ticker", "sector", "exchange", "country"]
    assert read_master(spark, None).isEmpty()


@pytest.mark.parametrize("source", [
    SnapshotMaster("/nowhere/at/all"),
    JdbcMaster("jdbc:none://nowhere/db", properties={"user": "u", "password": "p"}),
])
def test_unavailable_master_goes_on_empty(spark, raw, source):
    with pytest.warns(UserWarning, match="no master data"):
        empty = read_master(spark, source)
    bars = enrich(read_raw(spark, str(raw)), empty)
    assert {r[0] for r in bars.select("sector").collect()} == {"Unknown"}
    with pytest.raises(Exception):
        read_master(spark, source, required=True)


@pytest.mark.parametrize("layout", ["full", "compact"])
def test_layouts_round_trip(spark, bars, tmp_path, layout):
    path = str(tmp_path / "bars")
    counts = write_processed(bars, path, layout)
    assert counts.get["rows"] == 3
    back = read_bars(spark, path)
    assert back.columns == PROCESSED_BARS.names
    same = ["ticker", "sector", "year", "month", "day", "date", "close", "volume", "exchange"]
    assert rows(back, *same) == rows(bars, *same)
    folder = Path(path) / "sector=Unknown"
    inner = folder / "ticker=CCC" / "year=2023" if layout == "full" else folder / "year=2023"
    assert (inner / "month=11").is_dir()
    assert any("snappy" in f.name for f in Path(path).rglob("*.parquet"))


def test_append_twice_reads_once(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    write_processed(bars, path)
    write_processed(bars, path)
    assert read_bars(spark, path, unique=False).count() == 6
    assert read_bars(spark, path).count() == 3


@pytest.mark.parametrize("layout", ["full", "compact"])
def test_replace_is_idempotent_and_keeps_the_rest(spark, bars, tmp_path, layout):
    path = str(tmp_path / "bars")
    write_processed(bars, path, layout, "replace", str(tmp_path / "s0"))
    fixed = bars.where("ticker = 'AAA'").withColumns({
        "close": F.lit(9.0), "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 DAY")})
    extra = fixed.withColumns({"ticker": F.lit("ZZZ")})
    for attempt in (1, 2):
        write_processed(fixed.unionByName(extra), path, layout, "replace",
                        str(tmp_path / f"s{attempt}"))
    back = read_bars(spark, path, unique=False)
    assert rows(back, "ticker", "close") == [
        ("AAA", 9.0), ("BBB", 10.5), ("CCC", 20.5), ("ZZZ", 9.0)]


def test_interrupted_replace_is_finished_from_staging(spark, bars, tmp_path, monkeypatch):
    """The move was cut off after a folder was lost; the repeated call brings it back."""
    path, staging = tmp_path / "bars", str(tmp_path / "staging")
    write_processed(bars, str(path), "compact", "replace", str(tmp_path / "first"))
    news = bars.where("ticker = 'BBB'").withColumn("ticker", F.lit("NEW"))
    real = files._write_partitions

    def cut_off(df, target, *rest, **options):
        if target != staging:
            raise RuntimeError("lost")
        real(df, target, *rest, **options)

    with monkeypatch.context() as patch:
        patch.setattr(files, "_write_partitions", cut_off)
        with pytest.raises(RuntimeError):
            write_processed(news, str(path), "compact", "replace", staging)
    for file in (path / "sector=Tech").rglob("*.parquet"):
        file.unlink()
    write_processed(news, str(path), "compact", "replace", staging)
    assert rows(read_bars(spark, str(path), unique=False), "ticker") == [
        ("AAA",), ("BBB",), ("CCC",), ("NEW",)]
    assert not Path(staging).exists()


def test_compact_replace_reads_only_touched_months(spark, bars, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "bars"), str(tmp_path / "staging")
    write_processed(bars, path, "compact", "replace", str(tmp_path / "first"))
    plans = []
    real = files._write_partitions
    monkeypatch.setattr(files, "_write_partitions", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a, **k)))
    write_processed(bars.where("ticker = 'AAA'"), path, "compact", "replace", staging)
    assert re.search(r"PartitionFilters: \[\(?concat\(cast\(year#", plans[0])
    assert rows(read_bars(spark, path, unique=False), "ticker") == [("AAA",), ("BBB",), ("CCC",)]


def test_compact_replace_moves_a_bar_to_its_new_sector(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    other = bars.where("ticker = 'BBB'").withColumn("ticker", F.lit("TEC"))
    write_processed(bars.unionByName(other), path, "compact", "replace", str(tmp_path / "a"))
    moved = bars.where("ticker = 'BBB'").withColumns({
        "sector": F.lit("Media"), "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 DAY")})
    write_processed(moved, path, "compact", "replace", str(tmp_path / "b"))
    got = read_bars(spark, path, unique=False).where("ticker IN ('BBB', 'TEC')")
    assert rows(got, "ticker", "sector") == [("BBB", "Media"), ("TEC", "Tech")]


def test_changed_sector_reads_as_one_row(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    write_processed(bars, path, "full", "replace")
    moved = bars.where("ticker = 'BBB'").withColumns({
        "sector": F.lit("Media"), "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 DAY")})
    write_processed(moved, path, "full", "replace")
    got = read_bars(spark, path).where("ticker = 'BBB'")
    assert rows(got, "sector") == [("Media",)]


@pytest.mark.parametrize("layout", ["compact", "full"])
@pytest.mark.parametrize("before,after", [("Automotive", "Technology"), ("Technology", "Automotive")])
def test_replay_after_a_sector_change(spark, bars, tmp_path, layout, before, after):
    """The same file loaded again under another sector leaves one row, also in the files."""
    path = str(tmp_path / "bars")
    one = bars.where("ticker = 'BBB'")
    for i, sector in enumerate((before, after)):
        copy = one.withColumns({
            "sector": F.lit(sector), "ingested_at": F.lit(f"2024-03-0{i + 1}").cast("timestamp")})
        write_processed(copy, path, layout, "replace", str(tmp_path / f"stage{i}"))
    for unique in (False, True):
        assert rows(read_bars(spark, path, unique=unique), "ticker", "sector") == [("BBB", after)]
    register_partitioned(spark, f"replayed_{layout}_{after}", path, layout)
    assert rows(spark.table(f"replayed_{layout}_{after}"), "sector") == [(after,)]


def test_undated_rows_survive_a_merge(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    for i, close in enumerate((1.0, 2.0, 2.0)):
        undated = bars.where("ticker = 'BBB'").withColumns({
            "date": F.lit(None).cast("date"), "year": F.lit(None).cast("int"), "month": F.lit(None).cast("string"),
            "day": F.lit(None).cast("string"), "close": F.lit(close)})
        write_processed(undated, path, "compact", "replace", str(tmp_path / f"stage{i}"))
    assert rows(read_bars(spark, path), "close") == [(1.0,), (2.0,)]


def test_cut_off_batch_load_is_finished(spark, raw, tmp_path, monkeypatch):
    from panelmill.plans.load import load_batch

    path = str(tmp_path / "bars")
    real = files._write_partitions

    def stop_at_move(df, target, *args, **kwargs):
        if target == path:
            raise RuntimeError("cut off")
        real(df, target, *args, **kwargs)

    monkeypatch.setattr(files, "_write_partitions", stop_at_move)
    with pytest.raises(RuntimeError):
        load_batch(spark, str(raw), path, mode="replace")
    monkeypatch.setattr(files, "_write_partitions", real)
    land(tmp_path / "later", "D.csv", "DDD,2022-01-03,1,2,0.5,1.5,1,2024-01-06T00:00:00")
    assert load_batch(spark, str(tmp_path / "later"), path, mode="replace")["rows"] == 1
    assert rows(read_bars(spark, path), "ticker") == [("AAA",), ("BBB",), ("CCC",), ("DDD",)]


def test_bad_lines_and_awkward_names(spark, tmp_path):
    from panelmill.plans.load import load_batch, rejects_of

    root = tmp_path / "raw"
    land(root, "^N225 +x%.csv",
         "AAA,notadate,1,2,0.5,1.5,3,2024-01-06T00:00:00",
         "AAA,2024-01-04,1,2,0.5,1.5,10.0,2024-01-06T00:00:00",
         "AAA,2024-01-05,1,2,0.5,1.5,3,2024-01-06T00:00:00")
    path = str(tmp_path / "bars")
    counts = load_batch(spark, str(root), path)
    assert counts["rows"] == 1 and counts["rejected"] == 2
    assert rows(read_bars(spark, path), "source_file") == [("^N225 +x%.csv",)]
    bad = spark.read.json(rejects_of(path))
    assert rows(bad, "source_file") == [("^N225 +x%.csv",)] * 2
    assert any("notadate" in r[0] for r in rows(bad, "line"))


def test_publish_with_other_columns(spark, bars, tmp_path):
    root = str(tmp_path / "curated")
    publish(bars.select("ticker", F.lit(1).alias("a")), "shifting", root)
    publish(bars.select("ticker", F.lit(2).alias("b")), "shifting", root)
    assert rows(spark.table("shifting"), "b") == [(2,)] * 3
    publish(bars.select("ticker", F.lit(3).alias("b")), "shifting", root)
    assert spark.table("shifting").columns == ["ticker", "b"] and rows(spark.table("shifting"), "b") == [(3,)] * 3


def test_raw_sink_reads_back(spark, raw, tmp_path):
    df = read_raw(spark, str(raw)).drop(SOURCE_PATH)
    write_raw(df, str(tmp_path / "again"))
    back = read_raw(spark, str(tmp_path / "again")).drop(SOURCE_PATH)
    assert back.exceptAll(df).isEmpty() and back.count() == 3
    assert (tmp_path / "again" / "entity_key=AAA" / "y=2024" / "m=01" / "d=05").is_dir()


def test_partition_filters_reach_the_scan(spark, bars, tmp_path):
    from panelmill.plans import lookups

    path = str(tmp_path / "bars")
    write_processed(bars, path, "full")
    view = lookups.sector_view(read_bars(spark, path, unique=False), "Tech", 2024)
    plan = view._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("\n")[0]
    assert "(sector#" in filters and "(year#" in filters and "= Tech" in filters
    assert rows(view, "ticker", "month") == [("BBB", "02")]
    daily = read_bars(spark, path, unique=False).where("year = 2024 AND month = '01'")
    assert rows(daily, "ticker") == [("AAA",)]


def test_rebalanced_write_splits_a_hot_folder(spark, tmp_path):
    """One group's month with nearly all rows is written by several tasks."""
    from panelmill.sinks.files import _balanced

    df = spark.range(200_000).withColumns({
        "sector": F.lit("hot"), "pad": F.sha2(F.col("id").cast("string"), 256)})
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        _balanced(df, ["sector"], ["id"]).write.partitionBy("sector").parquet(str(tmp_path / "o"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "o" / "sector=hot").glob("*.parquet"))) > 3


def test_curated_sinks(spark, bars, tmp_path):
    path = str(tmp_path / "view")
    view = bars.select("ticker", "close", "year", "month")
    write_curated(view, path, by_month=True)
    assert (Path(path) / "year=2024" / "month=02").is_dir()
    write_curated(view.where("1 = 0"), path, by_month=True, if_missing=True)
    assert spark.read.parquet(path).count() == 3
    write_curated(view.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_registered_table_sees_new_partitions(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    write_processed(bars.where("ticker <> 'CCC'"), path, "full")
    register_partitioned(spark, "reg_bars", path, "full")
    assert spark.table("reg_bars").count() == 2
    write_processed(bars.where("ticker = 'CCC'"), path, "full")
    register_partitioned(spark, "reg_bars", path, "full")
    got = spark.sql("SELECT ticker FROM reg_bars WHERE year = 2023 AND month = '11'")
    assert rows(got, "ticker") == [("CCC",)]


@pytest.mark.parametrize("by_month", [False, True])
def test_publish_swaps_the_table(spark, bars, tmp_path, by_month):
    name = f"pub_{by_month}".lower()
    view = bars.select("ticker", "close", "year", "month")
    first = publish(view, name, str(tmp_path), by_month)
    second = publish(view.where("ticker = 'AAA'"), name, str(tmp_path), by_month)
    assert first != second and Path(first).is_dir()
    assert rows(spark.table(name), "ticker", "month") == [("AAA", "01")]


def test_bucketed_bars_need_no_exchange(spark, bars, tmp_path):
    from panelmill.plans.rankings import daily_returns

    df = daily_returns(write_bucketed(bars, "bucketed_bars", str(tmp_path), 4))
    assert df.count() == 3
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_master_upsert_twice(spark, tmp_path):
    t0 = F.lit("2024-01-01").cast("timestamp")
    base = spark.createDataFrame(
        [("AAA", "A", "Tech", True), ("BBB", "B", None, True)],
        "ticker string, name string, sector string, is_active boolean",
    ).withColumns({"created_at": t0, "updated_at": t0})
    publish(base, "stocks_master", str(tmp_path))
    new = spark.createDataFrame(
        [("BBB", "B2", "Media"), ("CCC", "C", "Tech")],
        "ticker string, name string, sector string")
    now = F.lit("2024-06-01").cast("timestamp")
    for _ in range(2):
        upsert_master(spark, "stocks_master", str(tmp_path), new, now)
    got = rows(spark.table("stocks_master"), "ticker", "name", "sector", "is_active",
               F.to_date("created_at"), F.to_date("updated_at"))
    jan, jun = dt.date(2024, 1, 1), dt.date(2024, 6, 1)
    assert got == [
        ("AAA", "A", "Tech", True, jan, jan), ("BBB", "B2", "Media", True, jan, jun),
        ("CCC", "C", "Tech", True, jun, jun)]


def test_table_takes_up_new_columns(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    write_processed(bars, path, "full")
    assert register_partitioned(spark, "evolving", path, "full", evolve=True) == []
    (bars.where("ticker = 'AAA'").withColumns({"adjusted": F.lit(1.25), "ticker": F.lit("NEW")})
     .write.mode("append").partitionBy("sector", "ticker", "year", "month", "day").parquet(path))
    assert register_partitioned(spark, "evolving", path, "full", evolve=True) == ["adjusted"]
    assert rows(spark.table("evolving"), "ticker", "adjusted") == [
        ("AAA", None), ("BBB", None), ("CCC", None), ("NEW", 1.25)]


def test_row_views_prune_and_replace(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    write_processed(bars, path, "full")
    register_partitioned(spark, "stock_data", path, "full")
    create_row_views(spark, "stock_data", 2030, "Tech")
    enriched, chosen = create_row_views(spark, "stock_data", 2024, "Tech")
    assert rows(spark.table(enriched), "ticker") == [("AAA",), ("BBB",)]
    assert "source_file" in spark.table(enriched).columns
    one = spark.sql(f"SELECT * FROM {chosen} WHERE ticker = 'BBB'")
    assert rows(one, "ticker", "month", "exchange") == [("BBB", "02", "Y")]
    assert one.columns[:2] == ["sector", "ticker"]


def test_bucket_count_follows_the_stored_size(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    write_processed(bars, path, "full")
    assert bucket_count(spark, path) == 8
    assert bucket_count(spark, path, target=200) > 8


def test_hot_ticker_is_split_when_the_master_is_large(spark, tmp_path, master):
    """Without a broadcast, the join splits a ticker with most of the raw rows."""
    raw = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 9, "AAA").otherwise(
            F.concat(F.lit("T"), F.col("id").cast("string"))).alias("ticker"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 9000).cast("int"))
        .alias("date"),
        *[F.rand(1).alias(c) for c in ("open", "high", "low", "close")],
        F.col("id").alias("volume"),
    ).repartition(8)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = enrich(raw, master)
        done = joined.groupBy("date").agg(F.count("sector").alias("n"), F.sum("close"))
        assert sum(r["n"] for r in done.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_preview(spark, bars):
    assert len(bars.limit(2).collect()) == 2


def test_load_of_one_day_and_required_master(spark, raw, tmp_path):
    from panelmill.plans.load import load_batch

    path = str(tmp_path / "bars")
    assert load_batch(spark, str(raw), path, day="2024-01-05")["rows"] == 1
    assert load_batch(spark, str(raw), str(tmp_path / "none"), day="yesterday")["rows"] == 0
    with pytest.raises(Exception):  # noqa: B017
        load_batch(spark, str(raw), path, SnapshotMaster(str(tmp_path / "missing")), require_master=True)


def test_upsert_adds_new_columns(spark):
    from panelmill.operators import upsert_by_key

    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    new = spark.createDataFrame([("b", 3, "n"), ("c", 4, "m")], "k string, x int, y string")
    got = upsert_by_key(old, new, "k", F.current_timestamp())
    assert rows(got, "k", "x", "y") == [("a", 1, None), ("b", 3, "n"), ("c", 4, "m")]
