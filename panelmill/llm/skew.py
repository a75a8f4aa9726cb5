"""Joins that no frequent key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than one in so many of the rows count as hot, so there are fewer hot keys than this.
HOT_SHARE = 500


def look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one row per key, whatever the frequency of a key.

    ``rows`` is read a few times and should be a stored, narrow table. The keys
    that hold more than 1/500 of all rows are at most 500, so their table rows
    are broadcast: those rows stay where they are. All others are shuffled, and
    then no key has more than 1/500 of the rows. Rows with a null key match nothing and stay where they are, too.
    """
    total, known = rows.agg(F.count(F.lit(1)), F.count(key)).first()
    blank = None
    if known < total:
        added = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name != key]
        blank, rows = rows.where(F.col(key).isNull()).select("*", *added), rows.where(F.col(key).isNotNull())
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = [r[0] for r in counts.where(F.col("n") * HOT_SHARE > total).select(key).limit(HOT_SHARE).collect()]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    found = (rows.where(~is_hot) if hot else rows).join(table.where(~F.col(key).isin(hot)) if hot else table, key, "left")
    if hot:
        few = F.broadcast(table.where(F.col(key).isin(hot)))
        found = rows.where(is_hot).join(few, key, "left").unionByName(found)
    return found if blank is None else found.unionByName(blank)
