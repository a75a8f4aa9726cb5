"""Window columns along one series.

A panel has one row per (series, date) and ``date`` is a calendar day, so one
window partition holds at most a row per day: about 36,500 rows a century,
however large the table is and however many raw rows or copies one entity has
(those are reduced before any window: see ``dedupe_bars``). All columns of one
spec share partitioning and order, so Spark needs a single exchange and sort
for the whole chain of lags and rolling frames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.schemas import BARS, PanelSpec

_ROLLING = {"avg": F.avg, "stddev": F.stddev_samp, "max": F.max, "count": F.count}


def series_window(df: DataFrame, spec: PanelSpec = BARS) -> WindowSpec:
    """One series in the order of its days.

    Finer times are refused: their number per series would have no bound.
    Aggregate such data to days first.
    """
    kind = df.schema[spec.date].dataType
    if not isinstance(kind, T.DateType):
        raise TypeError(f"column {spec.date} must be a date, not {kind.simpleString()}")
    return Window.partitionBy(*spec.series_keys).orderBy(spec.date)


def rolling(fn: str, col: str, rows: int, window: WindowSpec) -> Column:
    """avg, sample stddev, max or count over the current row and the ``rows - 1`` before."""
    return _ROLLING[fn](col).over(window.rowsBetween(1 - rows, Window.currentRow))


def with_previous(df: DataFrame, out: str, col: str, spec: PanelSpec = BARS) -> DataFrame:
    """Value of the series' previous row, null on its first."""
    return df.withColumn(out, F.lag(col).over(series_window(df, spec)))


def with_rolling(
    df: DataFrame, columns: dict[str, tuple[str, str, int]], spec: PanelSpec = BARS
) -> DataFrame:
    """Add trailing statistics: ``{out: (fn, column, rows)}``."""
    window = series_window(df, spec)
    return df.withColumns({
        out: rolling(fn, col, rows, window) for out, (fn, col, rows) in columns.items()
    })


def with_stitched_frames(
    df: DataFrame, value: str, level: str, short: int, long: int, spec: PanelSpec = BARS
) -> DataFrame:
    """Sample deviation and mean of ``value`` and maximum of ``level`` over the
    last ``short`` and ``long`` rows, as ``_sd20``, ``_mean20``, ``_peak20`` ...,
    with ``_count60`` non-null values in the long frame.

    Spark evaluates a sliding frame anew for every row. A long frame that is a
    multiple of the short one is instead put together from short frames, those
    ending here and ``short``, ``2 * short`` ... rows earlier: counts, means and
    squared deviations add up, as in a partial aggregate. Earlier frames that
    reach before the series' start are shorter or missing, just as the long
    frame is cut there.
    """
    if long % short:
        raise ValueError("the long frame must be a multiple of the short one")
    window = series_window(df, spec)
    sd, mean, peak = f"_sd{short}", f"_mean{short}", f"_peak{short}"
    parts = long // short
    df = with_rolling(df, {
        sd: ("stddev", value, short), mean: ("avg", value, short),
        peak: ("max", level, short), "_n": ("count", value, short),
    }, spec)
    frame = F.struct("_n", mean, sd, peak)
    df = df.withColumns({
        f"_part{k}": frame if k == 0 else F.lag(frame, k * short).over(window)
        for k in range(parts)
    })
    each = [F.col(f"_part{k}") for k in range(parts)]
    counts = [F.coalesce(p["_n"], F.lit(0)) for p in each]
    # Means as distances from the newest non-null one: equal means add nothing.
    base = F.coalesce(*[p[mean] for p in each])
    offsets = [F.coalesce(p[mean] - base, F.lit(0.0)) for p in each]
    df = df.withColumns({
        f"_count{long}": _plus(counts),
        "_base": base,
        "_shift": F.try_divide(
            _plus([n * d for n, d in zip(counts, offsets)]), _plus(counts)),
    })
    inner = [
        F.coalesce(p[sd] * p[sd] * (n - 1), F.lit(0.0)) for p, n in zip(each, counts)
    ]
    between = [
        n * (d - F.col("_shift")) * (d - F.col("_shift")) for n, d in zip(counts, offsets)
    ]
    df = df.withColumns({
        f"_sd{long}": F.when(
            F.col(f"_count{long}") > 1,
            F.sqrt((_plus(inner) + _plus(between)) / (F.col(f"_count{long}") - 1))),
        f"_mean{long}": F.col("_base") + F.col("_shift"),
        f"_peak{long}": F.greatest(*[p[peak] for p in each]),
    })
    # Columns of a window are computed once: a filter on them does not repeat what they are made of.
    here = window.rowsBetween(Window.currentRow, Window.currentRow)
    df = df.withColumns({c: F.first(c).over(here) for c in (f"_{x}{long}" for x in ("count", "sd", "mean", "peak"))})
    return df.drop("_n", "_base", "_shift", *[f"_part{k}" for k in range(parts)])


def _plus(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
