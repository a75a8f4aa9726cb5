"""The registered queries once more as SQL, written independently of the plans."""

from __future__ import annotations

from panelmill.contract.panels import DAMPING
from panelmill.contract.queries import MONTH, SECTOR, SEED_DAY, SINCE_YEAR, TICKERS, UPSERT_DAY


def snap(expr: str, digits: int = 6) -> str:
    return f"CAST(ROUND(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _ticker(key: str) -> str:
    return f"'T' || lpad(CAST({key} AS VARCHAR), 10, '0')"


RAW = f"""
sales AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS ship, l_extendedprice AS price, l_quantity,
         {{'k': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice}} AS pos
  FROM lineitem),
raw AS (
  SELECT {_ticker('l_suppkey')} AS ticker, ship AS date,
         arg_min(price, pos) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, pos) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume,
         ship + 1 AS fetched_on,
         {_ticker('l_suppkey')} || '_' || CAST(ship AS VARCHAR) || '.csv' AS source_file
  FROM sales GROUP BY l_suppkey, ship)"""

MASTER = f"""
master AS (
  SELECT {_ticker('s_suppkey')} AS ticker, s_name AS name, r_name AS sector,
         n_name AS exchange, r_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
  WHERE s_acctbal >= 0)"""

BARS = f"""WITH {RAW}, {MASTER},
bars AS (
  SELECT replace(coalesce(m.sector, 'Unknown'), ' ', '_') AS sector, raw.ticker AS ticker,
         CAST(year(date) AS INTEGER) AS year, strftime(date, '%m') AS month,
         strftime(date, '%d') AS day, date, open, high, low, close, volume,
         m.exchange AS exchange, m.country AS country, source_file
  FROM raw LEFT JOIN master m ON raw.ticker = m.ticker)"""

# The activity panel under the same column names, one series per user and type.
ACTIVITY = """WITH hits AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS d, value,
         {'t': ts, 'e': event_id, 'v': value} AS pos FROM events),
bars AS (
  SELECT user_id, event_type, d AS date, arg_min(value, pos) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, pos) AS close, count(*) AS volume
  FROM hits GROUP BY user_id, event_type, d)"""


def _daily_summary(panel: str, group: str) -> str:
    return f"""{panel}
SELECT {group}, date, count(*) AS ticker_count,
       {snap('avg(close)', 2)} AS avg_close, {snap('avg(volume)', 0)} AS avg_volume,
       {snap('min(low)', 2)} AS sector_min, {snap('max(high)', 2)} AS sector_max
FROM bars GROUP BY {group}, date"""


def _ranking(panel: str, group: str, entity: str, series: str) -> str:
    return f"""{panel},
chain AS (
  SELECT *, lag(close) OVER s AS before,
         avg(close) OVER (s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS mean20
  FROM bars WINDOW s AS (PARTITION BY {series} ORDER BY date)),
moves AS (
  SELECT *, (close - before) / nullif(before, 0) AS ret FROM chain WHERE before IS NOT NULL),
ranked AS (
  SELECT {group}, {entity}, date, close, {snap('ret * 100', 2)} AS daily_return, volume,
         {snap('(close - mean20) / nullif(mean20, 0) * 100', 2)} AS deviation_from_ma20,
         rank() OVER (g ORDER BY ret DESC NULLS LAST) AS return_rank,
         rank() OVER (g ORDER BY volume DESC NULLS LAST) AS volume_rank,
         {snap('CAST(volume AS DOUBLE) * 100 / nullif(sum(volume) OVER g, 0)', 2)}
           AS volume_share_pct
  FROM moves WINDOW g AS (PARTITION BY {group}, date))
SELECT * FROM ranked"""


def _volatility(panel: str, group: str, entity: str, series: str) -> str:
    return f"""{panel},
steps AS (
  SELECT {entity}, {group}, date, close, lag(close) OVER (PARTITION BY {series} ORDER BY date) AS p
  FROM bars),
rets AS (SELECT *, (close - p) / nullif(p, 0) AS r FROM steps WHERE p IS NOT NULL),
frames AS (
  SELECT {entity}, {group}, date, close,
         {snap('stddev_samp(r) OVER f20 * sqrt(252) * 100', 2)} AS volatility_20d,
         {snap('stddev_samp(r) OVER f60 * sqrt(252) * 100', 2)} AS volatility_60d,
         {snap('avg(r) OVER f60 * 252 * 100', 2)} AS annualized_return_60d,
         max(close) OVER f60 AS top
  FROM rets
  WINDOW f20 AS (PARTITION BY {series} ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         f60 AS (PARTITION BY {series} ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
risk AS (
  SELECT {entity}, {group}, date, volatility_20d, volatility_60d, annualized_return_60d,
         {snap('annualized_return_60d / nullif(volatility_60d, 0)', 2)} AS sharpe_ratio,
         {snap('(top - close) / nullif(top, 0) * 100', 2)} AS max_drawdown_pct,
         CASE WHEN volatility_60d < 15 THEN 'Low Risk'
              WHEN volatility_60d < 25 THEN 'Medium Risk' ELSE 'High Risk' END AS risk_category
  FROM frames WHERE volatility_60d IS NOT NULL)
SELECT * FROM risk"""


_COMPARISON = f"""{BARS},
days AS (
  SELECT sector, date, avg(close) AS c, avg(volume) AS v FROM bars GROUP BY sector, date),
trail AS (
  SELECT *, lag(c) OVER s AS pc,
         avg(c) OVER (s ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
         avg(c) OVER (s ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30
  FROM days WINDOW s AS (PARTITION BY sector ORDER BY date)),
later AS (
  SELECT *, lag(v) OVER (PARTITION BY sector ORDER BY date) AS pv,
         (c - pc) / nullif(pc, 0) AS ret
  FROM trail WHERE pc IS NOT NULL),
compared AS (
  SELECT sector, date, {snap('c', 2)} AS avg_close, {snap('v', 0)} AS avg_volume,
         {snap('ret * 100', 2)} AS sector_daily_return_pct,
         {snap('m7', 2)} AS ma7, {snap('m30', 2)} AS ma30,
         CASE WHEN {snap('m7', 10)} > {snap('m30', 10)} THEN 'Bullish'
              WHEN {snap('m7', 10)} < {snap('m30', 10)} THEN 'Bearish' ELSE 'Neutral' END
           AS trend,
         {snap('(v - pv) / nullif(pv, 0) * 100', 2)} AS money_flow_indicator,
         1 + (SELECT count(*) FROM later o WHERE o.date = later.date AND {snap('o.ret', 10)} > {snap('later.ret', 10)})
           AS performance_rank
  FROM later)
SELECT * FROM compared"""

_RANKING = _ranking(BARS, "sector", "ticker", "ticker")
_RISK = _volatility(BARS, "sector", "ticker", "ticker")

_RANKING_FULL = f"""{BARS},
chain AS (
  SELECT *, lag(close) OVER s AS before,
         avg(close) OVER (s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS mean20
  FROM bars WHERE close IS NOT NULL AND sector IS NOT NULL
  WINDOW s AS (PARTITION BY ticker ORDER BY date)),
moves AS (SELECT *, (close - before) / nullif(before, 0) AS ret FROM chain)
SELECT sector, ticker, date, {snap('open')} AS open, {snap('close')} AS close,
       {snap('high')} AS high, {snap('low')} AS low, volume, {snap('before')} AS prev_close,
       {snap('ret * 100')} AS daily_return_pct,
       rank() OVER (g ORDER BY ret DESC NULLS LAST) AS return_rank_in_sector,
       rank() OVER (g ORDER BY volume DESC NULLS LAST) AS volume_rank_in_sector,
       {snap('CAST(volume AS DOUBLE) * 100 / nullif(sum(volume) OVER g, 0)')} AS volume_share_pct,
       {snap('close - mean20')} AS ma20_deviation, year, month
FROM moves WINDOW g AS (PARTITION BY sector, date)"""

_COMPARISON_FULL = f"""{BARS},
days AS (
  SELECT sector, date, year, month, count(DISTINCT ticker) AS n, avg(close) AS c,
         min(close) AS lo, max(close) AS hi, stddev_samp(close) AS sd,
         CAST(sum(volume) AS BIGINT) AS vol, avg(volume) AS v
  FROM bars WHERE sector IS NOT NULL GROUP BY sector, date, year, month),
trail AS (
  SELECT *, lag(c) OVER s AS pc, CAST(lag(vol) OVER s AS DOUBLE) AS pvol,
         avg(c) OVER (s ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
         avg(c) OVER (s ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30
  FROM days WINDOW s AS (PARTITION BY sector ORDER BY date)),
rets AS (SELECT *, (c - pc) / nullif(pc, 0) AS ret FROM trail)
SELECT sector, date, n AS ticker_count, {snap('c')} AS avg_close, {snap('lo')} AS min_close,
       {snap('hi')} AS max_close, {snap('sd')} AS price_volatility, vol AS total_volume,
       {snap('v')} AS avg_volume, {snap('pc')} AS prev_avg_close,
       {snap('ret * 100')} AS sector_daily_return_pct,
       {snap('(vol - pvol) / nullif(pvol, 0) * 100')} AS volume_change_pct,
       rank() OVER (PARTITION BY date ORDER BY {snap('ret', 10)} DESC NULLS LAST) AS performance_rank,
       {snap('vol * ret', 4)} AS money_flow_indicator,
       {snap('m7')} AS ma7, {snap('m30')} AS ma30, year, month
FROM rets"""

_DAMPED = f"""{BARS.replace("bars AS (", "plain AS (", 1)},
bars AS (SELECT * REPLACE (close + {DAMPING} AS close) FROM plain)"""


def _risk_full(panel: str) -> str:
    return f"""{panel},
steps AS (
  SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS p
  FROM bars WHERE close IS NOT NULL),
rets AS (SELECT *, (close - p) / nullif(p, 0) AS r FROM steps),
frames AS (
  SELECT *, stddev_samp(r) OVER f20 AS sd20, stddev_samp(r) OVER f60 AS sd60,
         avg(r) OVER f20 AS mu20, close - max(close) OVER f20 AS drop20
  FROM rets
  WINDOW f20 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         f60 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
risk AS (
  SELECT ticker, sector, date, {snap('close')} AS close, {snap('r')} AS daily_return,
         {snap('sd20')} AS volatility_20d, {snap('sd60')} AS volatility_60d,
         {snap('sd20 * sqrt(252)')} AS annualized_volatility,
         {snap('mu20')} AS avg_return_20d, {snap('mu20 * 252')} AS annualized_return,
         {snap('CASE WHEN sd20 > 0 THEN mu20 / sd20 END')} AS sharpe_ratio_approx,
         {snap('drop20')} AS max_drawdown_20d,
         {snap('drop20 / nullif(close, 0) * 100')} AS max_drawdown_pct,
         rank() OVER (PARTITION BY sector, date ORDER BY {snap('sd20', 10)} DESC)
           AS volatility_rank_in_sector,
         CASE WHEN sd20 < 0.01 THEN 'Low' WHEN sd20 < 0.02 THEN 'Medium'
              WHEN sd20 < 0.03 THEN 'High' ELSE 'Very High' END AS risk_category,
         year, month
  FROM frames WHERE sd20 IS NOT NULL)
SELECT * FROM risk"""

_RISK_FULL = _risk_full(BARS)

_REPORT = f"""WITH {RAW},
asked AS (
  SELECT DISTINCT {_ticker('s_suppkey')} AS ticker FROM supplier
  UNION SELECT n_name FROM nation),
got AS (SELECT ticker, max(date) AS date, count(*) AS n FROM raw GROUP BY ticker),
bad AS (SELECT {_ticker('s_suppkey')} AS ticker, 'in debt' AS error FROM supplier
        WHERE s_acctbal < 0),
report AS (
  SELECT asked.ticker AS ticker, got.date AS date, coalesce(n, 0) AS records,
         CASE WHEN error IS NOT NULL THEN 'error' WHEN n IS NULL THEN 'no_data'
              ELSE 'success' END AS status, error
  FROM asked LEFT JOIN got ON asked.ticker = got.ticker
             LEFT JOIN bad ON asked.ticker = bad.ticker)"""

_SECTOR_ROWS = f"""SELECT sector, ticker, date, year, month, day, open, high, low, close, volume,
       exchange, country
FROM bars WHERE sector = '{SECTOR}' AND year >= {SINCE_YEAR}"""

ORACLES: dict[str, str] = {
    "bars_enriched": f"{BARS} SELECT * FROM bars",
    "bars_no_master": f"""WITH {RAW}
SELECT 'Unknown' AS sector, ticker, CAST(year(date) AS INTEGER) AS year,
       strftime(date, '%m') AS month, strftime(date, '%d') AS day, date,
       open, high, low, close, volume, CAST(NULL AS VARCHAR) AS exchange,
       CAST(NULL AS VARCHAR) AS country, source_file FROM raw""",
    "date_parts": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day FROM orders""",
    "source_file_name": """
SELECT page_id, regexp_extract(url, '[^/]*$') AS source_file,
       regexp_extract(url, '[^/]*$') AS decoded_file FROM pages""",
    "ticker_filter": f"""{BARS} SELECT ticker, date, close, volume FROM bars
WHERE ticker IN (SELECT trim(unnest(string_split('{TICKERS}', ','))))""",
    "dedupe_bars": f"""WITH {RAW}
SELECT ticker, date, open, high, low, close + CAST(close < open AS INTEGER) AS close, volume,
       fetched_on + CAST(close < open AS INTEGER) AS fetched_at,
       CASE WHEN close < open THEN 'fix_' || source_file ELSE source_file END AS source_file
FROM raw""",
    "master_upsert": f"""WITH {MASTER},
news AS (
  SELECT {_ticker('s_suppkey')} AS ticker, upper(s_name) AS name, 'Watched' AS sector,
         CAST(s_nationkey AS VARCHAR) AS country, s_acctbal > 0 AS is_active
  FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 5000)
SELECT ticker, name, sector, CAST(NULL AS VARCHAR) AS exchange, country, is_active,
       CASE WHEN ticker IN (SELECT ticker FROM master) THEN DATE '{SEED_DAY}'
            ELSE DATE '{UPSERT_DAY}' END AS created_at, DATE '{UPSERT_DAY}' AS updated_at
FROM news
UNION ALL
SELECT ticker, name, sector, exchange, country, TRUE, DATE '{SEED_DAY}', DATE '{SEED_DAY}'
FROM master WHERE ticker NOT IN (SELECT ticker FROM news)""",
    "latest_bar": f"""{BARS}
SELECT ticker, sector, date, open, high, low, close, volume FROM bars
WHERE (ticker, date) IN (SELECT (ticker, max(date)) FROM bars GROUP BY ticker)""",
    "ticker_counts": f"{BARS} SELECT ticker, count(*) AS records FROM bars GROUP BY ticker",
    "ingest_report": f"{_REPORT} SELECT * FROM report",
    "ingest_totals": f"""{_REPORT}
SELECT count(*) AS requested, count(*) FILTER (status = 'success') AS success,
       count(*) FILTER (status = 'no_data') AS no_data,
       count(*) FILTER (status = 'error') AS error FROM report""",
    "daily_returns": f"""{BARS},
steps AS (SELECT ticker, sector, date, close,
                 lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prev_close FROM bars)
SELECT ticker, sector, date, {snap('close')} AS close, {snap('prev_close')} AS prev_close,
       {snap('(close - prev_close) / nullif(prev_close, 0)')} AS daily_return FROM steps""",
    "moving_average": f"""{BARS}
SELECT ticker, date, {snap('close')} AS close,
       {snap('avg(close) OVER (PARTITION BY ticker ORDER BY date '
             'ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)')} AS ma20 FROM bars""",
    "rolling_volatility": f"""{BARS},
steps AS (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS p FROM bars),
rets AS (SELECT *, (close - p) / nullif(p, 0) AS r FROM steps)
SELECT ticker, date, {snap('stddev_samp(r) OVER f20')} AS sd20,
       {snap('stddev_samp(r) OVER f60')} AS sd60, {snap('avg(r) OVER f20')} AS mean20,
       {snap('avg(r) OVER f60')} AS mean60
FROM rets
WINDOW f20 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
       f60 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
    "rolling_drawdown": f"""{BARS},
peaks AS (
  SELECT ticker, date, close,
         max(close) OVER (s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS max20,
         max(close) OVER (s ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS max60
  FROM bars WINDOW s AS (PARTITION BY ticker ORDER BY date))
SELECT ticker, date, {snap('close')} AS close, {snap('max20')} AS max20, {snap('max60')} AS max60,
       {snap('(close - max20) / nullif(max20, 0) * 100')} AS drawdown20_pct,
       {snap('(close - max60) / nullif(max60, 0) * 100')} AS drawdown60_pct FROM peaks""",
    "volume_share": f"""{BARS},
sums AS (SELECT sector, date, CAST(sum(volume) AS BIGINT) AS sector_volume
         FROM bars GROUP BY sector, date)
SELECT sector, ticker, date, volume, sector_volume,
       {snap('CAST(volume AS DOUBLE) * 100 / nullif(sector_volume, 0)')} AS share_pct
FROM bars JOIN sums USING (sector, date)""",
    "sector_daily_summary": _daily_summary(BARS, "sector"),
    "ticker_monthly_summary": f"""{BARS}
SELECT ticker, sector, CAST(date_trunc('month', date) AS DATE) AS month,
       {snap('avg(close)', 2)} AS monthly_avg_close, {snap('max(high)', 2)} AS monthly_high,
       {snap('min(low)', 2)} AS monthly_low, CAST(sum(volume) AS BIGINT) AS total_volume,
       count(*) AS trading_days
FROM bars GROUP BY ticker, sector, date_trunc('month', date)""",
    "sector_performance_ranking": _RANKING,
    "cross_sector_comparison": _COMPARISON,
    "volatility_analysis": _RISK,
    "sector_performance_full": _RANKING_FULL,
    "cross_sector_full": _COMPARISON_FULL,
    "volatility_full": _RISK_FULL,
    "enriched_view": f"""{BARS}
SELECT ticker, date, year, month, day, open, high, low, close, volume, source_file
FROM bars WHERE year >= {SINCE_YEAR}""",
    "sector_view": f"""{BARS} {_SECTOR_ROWS}
  AND ticker = (SELECT min(ticker) FROM bars WHERE sector = '{SECTOR}')""",
    "sector_view_all": f"{BARS} {_SECTOR_ROWS}",
    "named_sector_daily": f"""{BARS}
SELECT sector, date, count(DISTINCT ticker) AS num_stocks, {snap('avg(close)')} AS avg_close_price,
       CAST(sum(volume) AS BIGINT) AS total_volume, {snap('min(low)')} AS sector_min_price,
       {snap('max(high)')} AS sector_max_price, {snap('stddev_samp(close)')} AS price_volatility
FROM bars WHERE year = {SINCE_YEAR} AND month = '{MONTH}' GROUP BY sector, date""",
    "named_sector_comparison": f"""{BARS}
SELECT sector, count(DISTINCT ticker) AS num_companies, {snap('avg(close)')} AS avg_price,
       {snap('avg(volume)')} AS avg_volume, CAST(sum(volume) AS BIGINT) AS total_volume,
       min(date) AS data_start_date, max(date) AS data_end_date, count(*) AS total_records
FROM bars WHERE year = {SINCE_YEAR} GROUP BY sector""",
    "daily_price_change": f"""{BARS},
steps AS (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS p FROM bars)
SELECT ticker, sector, date, close, p AS prev_close,
       {snap('(close - p) / nullif(p, 0) * 100', 2)} AS change_pct, volume,
       CASE WHEN close > p THEN 'UP' WHEN close < p THEN 'DOWN' ELSE 'FLAT' END AS direction
FROM steps WHERE p IS NOT NULL""",
    "latest_ranking": f"{_RANKING} WHERE date = (SELECT max(date) FROM ranked)",
    "top_sectors": f"{_COMPARISON} ORDER BY date DESC, performance_rank, sector LIMIT 10",
    "high_risk_rows": f"{_RISK} WHERE risk_category = 'High Risk'",
    "high_latest": f"""{_risk_full(_DAMPED)} WHERE risk_category = 'High'
ORDER BY date DESC, ticker LIMIT 10""",
    "latest_sector_days": f"{_daily_summary(BARS, 'sector')} ORDER BY date DESC, sector LIMIT 10",
    "dedupe_sector_change": f"""{BARS}
SELECT CASE WHEN right(ticker, 1) = '0' THEN 'A_' || sector ELSE sector END AS sector, ticker, date, close
FROM bars""",
    "activity_daily_summary": _daily_summary(ACTIVITY, "event_type"),
    "activity_ranking": _ranking(ACTIVITY, "event_type", "user_id", "user_id, event_type"),
    "activity_volatility": _volatility(ACTIVITY, "event_type", "user_id", "user_id, event_type"),
}
