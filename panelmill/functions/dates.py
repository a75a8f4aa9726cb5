"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_parts(df: DataFrame, date: str = "date") -> DataFrame:
    """Add year (int) and zero-padded month and day; parse the date if it is text."""
    if isinstance(df.schema[date].dataType, T.StringType):
        df = df.withColumn(date, F.to_date(date, "yyyy-MM-dd"))
    return df.withColumns({
        "year": F.year(date),
        "month": F.lpad(F.month(date).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(date).cast("string"), 2, "0"),
    })


def month_start(date: str) -> Column:
    return F.trunc(date, "month")


def previous_day() -> Column:
    """The date before the session's current one."""
    return F.date_sub(F.current_date(), 1)
