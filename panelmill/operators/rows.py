"""Operators that choose one row per key.

All of them aggregate, so copies of a key are reduced before the shuffle and a
key with very many copies never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.schemas import BARS, PanelSpec


def _greatest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the whole row that is greatest by ``order``.

    The remaining columns follow in the comparison, so the choice is the same
    on every run even if ``order`` ties. A null counts as smallest.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    best = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return best.select(*[
        F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns
    ])


def dedupe_bars(
    df: DataFrame,
    spec: PanelSpec = BARS,
    order: Sequence[str] = ("fetched_at", "ingested_at", "source_file"),
) -> DataFrame:
    """One row per (series, date): the latest copy, also when the group changed.

    A copy fetched later wins; of copies of one fetch, such as a replayed file,
    the one loaded later. Rows without a date have no key: they stay, but for
    those that only differ in when they were loaded.
    """
    content = [c for c in df.columns if c != "ingested_at"]
    undated = F.when(F.col(spec.date).isNull(), F.xxhash64(*content))
    keyed = df.withColumn("_undated", undated)
    found = _greatest_row(keyed, [*spec.row_keys, "_undated"], [c for c in order if c in df.columns])
    return found.drop("_undated")


def latest_per_entity(df: DataFrame, spec: PanelSpec = BARS) -> DataFrame:
    """The newest row of every series."""
    return _greatest_row(df, spec.series_keys, [spec.date])


def upsert_by_key(old: DataFrame, new: DataFrame, key: str, now: Column) -> DataFrame:
    """Insert new keys and overwrite known ones; both sides hold a key once.

    A row of ``new`` replaces every column it brings, nulls included. Known
    keys keep their creation time; every written key gets ``now`` as update
    time. Rows of ``old`` without news stay as they are. Columns that only
    ``new`` has are added, null for rows without news.
    """
    stamps = ("created_at", "updated_at")
    n, o = new.alias("n"), old.alias("o")
    written = F.col(f"n.{key}").isNotNull()
    known = F.col(f"o.{key}").isNotNull()
    out = []
    for c in old.columns:
        if c == key:
            value = F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
        elif c == "created_at":
            value = F.when(known, F.col("o.created_at")).otherwise(now)
        elif c == "updated_at":
            value = F.when(written, now).otherwise(F.col("o.updated_at"))
        elif c in new.columns and c not in stamps:
            value = F.when(written, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        elif c == "is_active":
            value = F.when(known, F.col("o.is_active")).otherwise(F.lit(True))
        else:
            value = F.col(f"o.{c}")
        out.append(value.alias(c))
    out += [F.col(f"n.{c}").alias(c) for c in new.columns if c not in old.columns]
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(*out)
