"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.shared import discard, folders_made, stored
from panelmill.llm.skew import look_up


def _state(edges: DataFrame) -> tuple:
    """Number of the edges and two sums of hashes: equal for equal edge tables."""
    one = F.xxhash64("high", "low")
    row = edges.agg(F.count(F.lit(1)), F.sum(one.cast("decimal(20,0)")), F.bit_xor(one)).first()
    return tuple(row)


def _to_smallest(edges: DataFrame, of: str, to: str, keep) -> DataFrame:
    """Edges from the neighbours ``to`` of each node ``of`` to the smallest of them all."""
    edges = stored(edges, "star")
    least = edges.groupBy(of).agg(F.min(to).alias("least")).withColumn("least", F.least("least", of))
    return keep(look_up(edges, least, of))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node that an edge names.

    ``edges`` has columns a and b of one orderable type; direction, repeats and
    loops do not matter. Alternates two steps until nothing changes: all larger
    neighbours of a node are linked to its smallest neighbour, then all smaller
    ones. The result is a star for each component, after a number of rounds that
    grows with the logarithm of its size. A round is a few joins of narrow rows,
    written to the shared folder; nodes with very many neighbours are looked up
    without a shuffle; each round deletes the tables of the one before. An empty table gives no rows; null ends are ignored.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    spark = edges.sparkSession
    edges = stored(edges, "edges")
    state, last = _state(edges), folders_made()[-1]
    while True:
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        large = _to_smallest(both, "low", "high", lambda e: e.where("high > low").select("high", F.col("least").alias("low")))
        large = large.where("high <> low").distinct()
        small = _to_smallest(
            large, "high", "low",
            lambda e: e.select("high", F.col("least").alias("low"))
            .unionByName(e.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))),
        )
        edges = stored(small.distinct(), "edges")
        before, state = state, _state(edges)
        made = folders_made()  # the round's edges are written: what led to them goes
        discard(spark, made[made.index(last):-1])
        last = made[-1]
        if before == state:
            break
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
