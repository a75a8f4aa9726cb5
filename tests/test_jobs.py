"""The jobs end to end, and SQL over what they leave."""

import pytest

from panelmill.__main__ import main
from panelmill.session import cluster_settings
from panelmill.sources import read_bars
from test_sources_sinks import SEED, land, rows


@pytest.fixture
def lake(tmp_path):
    for day, close in enumerate([100, 110, 99], 1):
        land(tmp_path / "raw" / "AAA", f"{day}.csv",
             f"AAA,2024-01-0{day},{close},{close},{close},{close},5,2024-02-01T00:00:00")
        land(tmp_path / "raw" / "BBB", f"{day}.csv",
             f"BBB,2024-01-0{day},{close},{close},{close},{close},5,2024-02-01T00:00:00")
    (tmp_path / "seed.json").write_text(SEED)
    return tmp_path


@pytest.mark.parametrize("layout,mode", [
    ("full", "append"), ("full", "replace"), ("compact", "append"), ("compact", "replace")])
def test_load_job(spark, lake, capsys, layout, mode):
    args = ["load", "--raw", str(lake / "raw"), "--processed", str(lake / "bars"),
            "--layout", layout, "--mode", mode, "--master-seed", str(lake / "seed.json")]
    assert main(args) == 0
    assert "'rows': 6" in capsys.readouterr().out
    assert main(args) == 0
    stored = read_bars(spark, str(lake / "bars"), unique=False)
    assert stored.count() == (12 if mode == "append" else 6)
    assert rows(read_bars(spark, str(lake / "bars")).select("ticker", "sector").distinct(), "*") == [
        ("AAA", "Fine_Arts"), ("BBB", "Tech")]


def test_stream_and_refresh_jobs_with_lookups(spark, lake, capsys):
    assert main(["stream", "--raw", str(lake / "raw"), "--processed", str(lake / "bars"),
                 "--checkpoint", str(lake / "check"), "--curated", str(lake / "curated")]) == 0
    assert capsys.readouterr().out.count("SUCCEEDED") == 5
    latest = spark.sql("""SELECT * FROM sector_performance_ranking
                          WHERE date = (SELECT max(date) FROM sector_performance_ranking)""")
    assert rows(latest, "ticker", "daily_return") == [("AAA", -10.0), ("BBB", -10.0)]
    high = spark.sql("""SELECT * FROM volatility_analysis WHERE risk_category = 'High Risk'
                        ORDER BY date DESC LIMIT 10""")
    assert high.count() == 2
    assert main(["refresh", "--processed", str(lake / "bars"), "--curated", str(lake / "curated"),
                 "--views", "cross_sector_full, nonsense"]) == 1
    out = capsys.readouterr().out
    assert "cross_sector_full SUCCEEDED" in out and "nonsense FAILED" in out


def test_settings_follow_the_data():
    assert cluster_settings(10)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_settings(10**12)["spark.sql.shuffle.partitions"] == "7451"
    assert cluster_settings(10**14)["spark.sql.shuffle.partitions"] == "50000"
