"""Ranks and totals inside a group, for groups of any size.

A (group, date) holds every entity of that group, which may be a large part of
the table. There is one lazy plan, without a job before the action and without
a setting by the caller. Groups are counted with map-side combine; those with more than
one in ``slots`` of all rows are large, so there are fewer large groups than
slots, and their names are broadcast. Small groups are ranked by plain windows, all ranks and totals in one
exchange; where no group is large, nothing else is shuffled but the counts. The values of large groups are cut at
their common quantiles, which come from a mergeable sketch. The rows of a large group between two cuts are ranked on
their own, and the number of its rows above the slot is added: counted exactly, so the ranks are
exact for any cuts. Rows on a cut that is the value of very many rows tie, and
are spread over as many pieces as the cut fills slots. So no task gets a group, or a tie, for itself.

Tables known to be smaller than a task's share are ranked by plain windows; files
tell their size when the plan is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Input that one task can sort, whatever it holds.
TASK_BYTES = 256 * 1024 * 1024
MAX_SLOTS = 2000


def with_group_standing(
    df: DataFrame,
    keys: Sequence[str],
    identity: Sequence[str],
    ranks: dict[str, str],
    totals: dict[str, str] | None = None,
    sized_by: DataFrame | None = None,
    slots: int | None = None,
) -> DataFrame:
    """Add ``rank() over (partition by keys order by column desc nulls last)``
    for every ``{out: column}`` of ``ranks``, and the group's sum for every one
    of ``totals``.

    ``identity`` names columns that tell the rows of a group apart. ``sized_by``
    may be a cheaper table with at least the rows of ``df`` in every group, to
    measure the groups on. Ranked columns must not depend on the order of summation,
    since they are read more than once. Null keys form a group like any other.
    ``slots`` is for tests: it splits by so many, whatever the input's size.
    """
    totals = totals or {}
    if slots is None:
        if input_bytes(df) <= TASK_BYTES:
            return _by_window(df, keys, ranks, totals)
        slots = _slots(df)
    out = [*df.columns, *ranks, *totals]
    big = _large_groups(df if sized_by is None else sized_by, keys, slots)
    small = _met(df, keys, big, "left_anti")
    large = _ranked(_placed(df, keys, identity, ranks, sized_by, slots), ranks, totals)
    return large.select(*out).union(_by_window(small, keys, ranks, totals).select(*out))


def input_bytes(df: DataFrame) -> int:
    """Size of the tables that a plan reads, as Spark knows it without reading them."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _slots(df: DataFrame) -> int:
    return min(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_SLOTS)


def _by_window(df, keys, ranks, totals) -> DataFrame:
    group = Window.partitionBy(*keys)
    columns = {
        out: F.rank().over(group.orderBy(F.desc_nulls_last(col))).cast("bigint")
        for out, col in ranks.items()
    }
    columns |= {out: F.sum(col).over(group) for out, col in totals.items()}
    return df.withColumns(columns)


def _large_groups(sized_by: DataFrame, keys, slots) -> DataFrame:
    """``_big``, the keys of each group with more than one in ``slots`` of all rows: fewer than ``slots`` rows.

    A struct is never null, and equal where all keys are equal or null.
    """
    sizes = sized_by.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = sizes.agg(F.sum("_n").alias("_rows")).scalar()
    return sizes.where(F.col("_n") * slots > rows).select(F.struct(*keys).alias("_big"))


def _met(df, keys, big: DataFrame, how: str) -> DataFrame:
    """The rows of large groups (``left_semi``) or of the others (``left_anti``), with their group ``_g``."""
    return df.withColumn("_g", F.struct(*keys)).join(F.broadcast(big), F.col("_g") == F.col("_big"), how)


def _if_any(df, identity, big: DataFrame) -> DataFrame:
    """The rows, or none if no group is large.

    The filter names the identity, so that it moves below windows and aggregates along it, to what they read.
    """
    found = df.sparkSession.range(1).join(F.broadcast(big), how="left_semi").agg(F.count(F.lit(1))).scalar()
    return df.where(F.pmod(F.xxhash64(*identity), F.lit(1)) < found)


def _placed(df, keys, identity, ranks, sized_by, slots) -> DataFrame:
    """The rows of large groups with their group ``_g``, and ``_slot_i`` and ``_piece_i`` for each rank.

    Slots count from the greatest values on. Without a large group nothing is shuffled for these rows.
    """
    big = _large_groups(df if sized_by is None else sized_by, keys, slots)
    spread = F.xxhash64(*identity)
    df = _met(_if_any(df, identity, big), keys, big, "left_semi")
    if not ranks:
        return df.withColumns({"_slot_0": F.lit(0), "_piece_0": F.pmod(spread, F.lit(slots)).cast("bigint")})
    df = df.crossJoin(F.broadcast(_cuts(df, ranks, slots)))  # one row with the cuts of all ranks
    for i, col in enumerate(ranks.values()):
        cuts, value = F.col(f"_cuts_{i}"), F.col(col)
        df = df.withColumn("_below", _below(cuts["at"], value, slots))
        on_cut = F.coalesce(F.get(cuts["at"], F.col("_below")) == value, F.lit(False))
        slot = F.when(value.isNull(), 1).otherwise(-(2 * F.col("_below") + on_cut.cast("int")))
        parts = F.when(value.isNull(), cuts["nulls"]).when(on_cut, F.get(cuts["times"], F.col("_below"))).otherwise(1)
        df = df.withColumns({
            f"_slot_{i}": slot, f"_piece_{i}": F.pmod(spread, parts.cast("bigint")),
        }).drop("_below", f"_cuts_{i}")
    return df


def _cuts(large: DataFrame, ranks: dict[str, str], slots: int) -> DataFrame:
    """One row: for each rank the quantiles ``at``, sorted, how many slots each fills, and how many nulls would."""
    shares = F.array(*[F.lit(k / slots) for k in range(1, slots)])
    found = large.agg(F.count(F.lit(1)).alias("rows"), *[
        x for i, col in enumerate(ranks.values())
        for x in (F.percentile_approx(col, shares, 10 * slots).alias(f"raw_{i}"), F.count(col).alias(f"n_{i}"))
    ])
    out = []
    for i in range(len(ranks)):
        raw = F.coalesce(f"raw_{i}", F.array().cast(found.schema[f"raw_{i}"].dataType))
        at = F.array_sort(F.array_distinct(raw))
        times = _frequencies(at, raw)
        nulls = F.ceil((F.col("rows") - F.col(f"n_{i}")) * slots / F.greatest("rows", F.lit(1))) + 1
        out.append(F.struct(at.alias("at"), times.alias("times"), nulls.alias("nulls")).alias(f"_cuts_{i}"))
    return found.select(*out)


def _frequencies(values: Column, among: Column) -> Column:
    return F.transform(values, lambda x: F.size(F.filter(among, lambda y: y == x)) + 1)


def _below(cuts: Column, value: Column, slots: int) -> Column:
    """How many of the sorted cuts are less than the value, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(slots.bit_length()))])
    step = lambda found, by: F.when(
        (found + by <= F.size(cuts)) & (F.get(cuts, found + by - 1) < value), found + by).otherwise(found)
    return F.aggregate(steps, F.lit(0), step)


def _ranked(placed: DataFrame, ranks, totals) -> DataFrame:
    """Ranks within pieces plus the rows above them; totals and counts come by the piece, without another exchange."""
    out = placed
    for i, (name, col) in enumerate(list(ranks.items()) or [(None, None)]):
        piece = ["_g", f"_slot_{i}", f"_piece_{i}"]
        sums = totals if i == 0 else {}
        counts = placed.groupBy(*piece).agg(F.count(F.lit(1)).alias("_count"), *[F.sum(c).alias(t) for t, c in sums.items()])
        # a group has at most a few times ``slots`` pieces
        group = Window.partitionBy("_g")
        above = group.orderBy(piece[1]).rangeBetween(Window.unboundedPreceding, -1)
        counts = counts.select(
            *piece, F.coalesce(F.sum("_count").over(above), F.lit(0)).alias("_above"),
            *[F.sum(t).over(group).alias(t) for t in sums],
        )
        if name:
            local = Window.partitionBy(*piece).orderBy(F.desc_nulls_last(col))
            out = out.withColumn("_local", F.rank().over(local))
        out = out.join(counts, piece, "left")
        if name:
            out = out.withColumn(name, (F.col("_above") + F.col("_local")).cast("bigint")).drop("_local")
        out = out.drop("_above")
    return out
