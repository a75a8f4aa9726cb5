"""Column helpers for prices, returns and classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def snap_round(col: Column, digits: int) -> Column:
    """Round half up after snapping to ten decimals.

    Sums and deviations of doubles depend in their last bits on the order of
    the rows; the snap keeps such noise from deciding a half.
    """
    return F.round(col.cast("double").cast("decimal(38,10)"), digits).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null for a zero divisor."""
    return F.try_divide(top, bottom)


def change(new: Column, old: Column) -> Column:
    """Relative change from old to new."""
    return ratio(new - old, old)


def pct_change(new: Column, old: Column) -> Column:
    return change(new, old) * 100


def classify(col: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound the value lies strictly below, else the last label.

    A null value has no class.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("classify needs one label more than bounds")
    out = F.when(col.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        out = out.when(col < bound, label)
    return out.otherwise(labels[-1])
