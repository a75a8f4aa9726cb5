"""Approximate nearest neighbours through learned partitions.

A bounded sample is linked by exact nearest neighbours, the graph is cut into
balanced parts, and a softmax classifier learns which part a vector's neighbours
lie in. Every vector is filed under its most probable part; a query visits its
most probable parts, as many as the sample's links need, and ranks what it finds by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.shared import map_batches, stored
from panelmill.llm.skew import look_up

#: Vectors that the index is learned on, at most: those with the smallest hashes.
FIT_ROWS = 16_000
#: Links of a sample vector to its nearest ones.
LINKS = 10
#: The number of parts follows the distinct vectors, within what the sample can teach.
ROWS_A_PART, LEAST_PARTS, MOST_PARTS = 800, 32, 1024
#: Share of the sample's own links that the probed parts must hold. It sets the number of probes:
#: few for vectors that lie in clusters, more than half of the parts for vectors that do not.
RECALL = 0.965
#: A part may have so many times its even share of the sample.
SLACK = 1.1
#: Vectors of one part that a task holds at once; larger parts are split.
BLOCK = 4096


@dataclass
class Router:
    """A linear softmax classifier over normalised vectors."""

    weights: np.ndarray  # (dimensions + 1, parts)

    def scores(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.weights[:-1] + self.weights[-1]

    def best(self, unit: np.ndarray, many: int) -> np.ndarray:
        """The most probable parts, best first."""
        return np.argsort(-self.scores(unit), axis=1, kind="stable")[:, :many]


def nearest_links(unit: np.ndarray, links: int) -> np.ndarray:
    """(n, links) numbers of the nearest others by cosine, block by block."""
    links = min(links, len(unit) - 1)
    found = np.zeros((len(unit), max(links, 0)), np.int64)
    for begin in range(0, len(unit) if links > 0 else 0, 1024):
        near = unit[begin:begin + 1024] @ unit.T
        near[np.arange(len(near)), begin + np.arange(len(near))] = -np.inf
        found[begin:begin + 1024] = np.argpartition(-near, links - 1, axis=1)[:, :links]
    return found


def balanced_parts(unit: np.ndarray, links: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Part of each vector: few links between parts, none above the slack.

    Starts from bisections at the median along the direction of most spread,
    which are balanced, and then moves vectors to the part where most of their
    links lie, as long as that part has room and its links grow.
    """
    part = np.zeros(len(unit), np.int64)
    groups = [np.arange(len(unit))]
    while len(groups) < parts:
        groups.sort(key=len)
        largest = groups.pop()
        if len(largest) < 2:
            groups.append(largest)
            break
        local = unit[largest] - unit[largest].mean(axis=0)
        axis = np.linalg.eigh(local.T @ local)[1][:, -1]
        order = largest[np.argsort(local @ axis, kind="stable")]
        groups += [order[: len(order) // 2], order[len(order) // 2:]]
    for i, group in enumerate(groups):
        part[group] = i
    room = SLACK * len(unit) / max(1, len(groups))
    size = np.bincount(part, minlength=parts)
    ends = np.concatenate([links.ravel(), np.repeat(np.arange(len(unit)), links.shape[1])])
    starts = np.concatenate([np.repeat(np.arange(len(unit)), links.shape[1]), links.ravel()])
    for _ in range(rounds):
        votes = np.bincount(starts * parts + part[ends], minlength=len(unit) * parts).reshape(-1, parts)
        wish = votes.argmax(axis=1)
        gain = votes[np.arange(len(unit)), wish] - votes[np.arange(len(unit)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[wish[i]] + 1 <= room:
                size[part[i]] -= 1
                size[wish[i]] += 1
                part[i] = wish[i]
                moved += 1
        if not moved:
            break
    return part


def learn_router(unit: np.ndarray, links: np.ndarray, part: np.ndarray, parts: int, rounds: int = 120) -> Router:
    """Softmax regression of the parts in which a vector and its links lie, by Adam."""
    unit = unit.astype(np.float64)
    target = np.zeros((len(unit), parts))
    np.add.at(target, (np.repeat(np.arange(len(unit)), links.shape[1]), part[links.ravel()]), 1.0)
    target[np.arange(len(unit)), part] += 1.0
    target /= target.sum(axis=1, keepdims=True)
    x = np.hstack([unit, np.ones((len(unit), 1))])
    weights, moment, square = (np.zeros((x.shape[1], parts)) for _ in range(3))
    for t in range(1, rounds + 1):
        z = x @ weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (z / z.sum(axis=1, keepdims=True) - target) / len(x) + 1e-6 * weights
        moment = 0.9 * moment + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        weights -= 0.3 * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
    return Router(weights)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vector of the rows that take part: not null, not zero, all components finite."""
    rows = vectors.select(vectors[key].alias("key"), vectors[vector].cast("array<double>").alias("vector"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return rows.where(F.col("key").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0))


def probes_needed(router: Router, unit: np.ndarray, links: np.ndarray, recall: float) -> int:
    """The fewest best parts of a vector that hold this share of all links."""
    home = router.best(unit, 1)[:, 0]
    parts = router.weights.shape[1]
    place = np.argsort(router.best(unit, parts), axis=1)  # of each part in a vector's order
    needed = np.sort(place[np.arange(len(unit))[:, None], home[links]].ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1 if len(needed) else 1


def learn(
    vectors: DataFrame, rows: int, dimensions: int, parts: int | None = None, fit_rows: int = FIT_ROWS, recall: float = RECALL
) -> tuple[Router, int]:
    """The router for the ``rows`` vectors of this length, and the number of probes, from at most ``fit_rows`` of them."""
    # about as many as asked for pass by their hash, and the surplus is cut off in order
    least = F.lit(min(2**63 - 1, int(-(2**63) + 2**64 * (1.1 * fit_rows + 100) / max(1, rows))))
    sample = vectors.select("vector").where((F.size("vector") == dimensions) & (F.xxhash64("vector") <= least))
    sample = sample.orderBy(F.xxhash64("vector")).limit(fit_rows).toArrow().column("vector").combine_chunks()
    parts = parts or min(MOST_PARTS, max(LEAST_PARTS, rows // ROWS_A_PART))
    unit = _unit(_matrix(sample, dimensions)).astype(np.float32) if len(sample) else np.zeros((0, dimensions), np.float32)
    parts = max(1, min(parts, len(unit) // 8))
    if len(unit) < 2:
        return Router(np.zeros((dimensions + 1, 1))), 1
    links = nearest_links(unit, LINKS)
    router = learn_router(unit, links, balanced_parts(unit, links, parts), parts)
    return router, probes_needed(router, unit, links, recall)


def learn_each(
    vectors: DataFrame, parts: int | None = None, fit_rows: int = FIT_ROWS, recall: float = RECALL
) -> dict[int, tuple[Router, int]]:
    """A router and its probes for the most frequent length of vectors and each with more than ``fit_rows``.

    Vectors of any other length are few enough to be one part, which is searched whole.
    """
    counts = vectors.groupBy(F.size("vector").alias("dimensions")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy(F.desc("n"), "dimensions").limit(1)
    lengths = {r.dimensions: r.n for r in counts.where(F.col("n") > fit_rows).unionByName(first).collect()}
    return {d: learn(vectors, n, d, parts, fit_rows, recall) for d, n in sorted(lengths.items())}


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, parts: int | None = None, recall: float = RECALL,
    fit_rows: int = FIT_ROWS, block: int = BLOCK, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """For each query row: query_id, rank (from 1), the key of a near row of ``vectors`` and the cosine ``score``.

    The nearest ``k`` of what the probed parts hold, the row with the query's own key left
    out, by largest cosine in double precision, ties by smaller key. Rows whose
    vector is null, zero, or has null or non-finite components take no part, nor
    do null keys. Vectors of different lengths have no cosine: each length is
    indexed apart, and a query meets the vectors of its own length.

    Equal vectors are one entry of the index with their k + 1 smallest keys,
    which is all that a ranking can need, and equal queries are asked once;
    their rows are restored at the end. Parts larger than ``block`` are split
    into blocks, and the queries go to each of them; a block yields the k + 1
    best entries of each query, which are merged by query. Every vector is indexed; only
    the partition is learned on a sample. An empty table gives no rows.
    """
    every = usable(vectors, key, vector).withColumn("entry", F.xxhash64("vector"))
    # a task's own keys of a vector come first, so that no vector gathers all its keys at once
    smallest = lambda keys: F.slice(F.array_sort(F.array_distinct(keys)), 1, k + 1)
    by_task = every.groupBy("entry", F.spark_partition_id().alias("task"))
    entries = by_task.agg(F.first("vector").alias("vector"), smallest(F.collect_list("key")).alias("keys"))
    entries = entries.groupBy("entry").agg(F.first("vector").alias("vector"), smallest(F.flatten(F.collect_list("keys"))).alias("keys"))
    entries = stored(entries, "entries")
    routers = learn_each(entries, parts, fit_rows, recall)
    asked = stored(usable(queries, key, vector).withColumn("query", F.xxhash64("vector")), "queries")

    def route(probing: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for mixed in batches:
                lengths = pc.list_value_length(mixed.column("vector"))
                for dimensions in pc.unique(lengths).to_pylist():
                    batch = mixed.filter(pc.equal(lengths, dimensions))
                    best = np.zeros((len(batch), 1), np.int64)
                    if dimensions in routers:
                        router, probes = routers[dimensions]
                        best = router.best(_unit(_matrix(batch.column("vector"), dimensions)), probes if probing else 1)
                    at = pa.array(np.repeat(np.arange(len(batch)), best.shape[1]))
                    rest = pa.RecordBatch.from_arrays([c.take(at) for c in batch.columns], names=batch.schema.names)
                    yield rest.append_column("part", pa.array((dimensions << 32) + best.ravel()))

        return run

    filed = map_batches(
        entries.select("entry", "vector", "keys"), route(probing=False),
        "entry bigint, vector array<double>, keys array<bigint>, part bigint",
    )
    filed = stored(filed, "filed")
    blocks = filed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    distinct = asked.groupBy("query").agg(F.first("vector").alias("vector"))
    visits = map_batches(distinct, route(probing=True), "query bigint, vector array<double>, part bigint")
    filed = look_up(filed, blocks, "part").select(
        "part", F.pmod("entry", "blocks").cast("int").alias("block"), "entry", "vector", "keys"
    )
    visits = look_up(stored(visits, "visits"), blocks, "part").where("blocks IS NOT NULL").select(
        "part", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.col("query").alias("entry"), "vector",
        F.lit(None).cast("array<bigint>").alias("keys"),
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, waiting = None, [], []

        def ask() -> pa.RecordBatch:
            stored_, asks = pa.Table.from_batches(held), pa.Table.from_batches(waiting)
            waiting.clear()
            dimensions = place[0] >> 32
            have = _matrix(stored_.column("vector").combine_chunks(), dimensions)
            want = _matrix(asks.column("vector").combine_chunks(), dimensions)
            all_keys = stored_.column("keys").to_pylist()
            firsts = np.array([x[0] for x in all_keys])
            exact, top = best_entries(have, want, firsts, min(k + 1, len(have)))
            at = pa.array(np.repeat(np.arange(len(want)), top.shape[1]))
            keys = pa.array([all_keys[j] for j in top.ravel()], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [asks.column("entry").combine_chunks().take(at), pa.array(exact.ravel()), keys],
                names=["query", "score", "keys"],
            )

        for batch in batches:
            for part in _runs(batch):
                here = (part.column("part")[0].as_py(), part.column("block")[0].as_py())
                if here != place:
                    if held and waiting:
                        yield ask()
                    place, held, waiting = here, [], []
                is_query = part.column("keys").is_null()
                stays, asks = part.filter(pc.invert(is_query)), part.filter(is_query)
                if len(stays):
                    held.append(stays)
                if len(asks):
                    waiting.append(asks)
                    if held and sum(map(len, waiting)) >= 256:
                        yield ask()
        if held and waiting:
            yield ask()

    both = filed.unionByName(visits).repartition("part", "block")
    both = both.sortWithinPartitions("part", "block", F.col("keys").isNull())  # entries before queries
    found = map_batches(both, rank, "query bigint, score double, keys array<bigint>")
    hit = F.struct((-F.col("score")).alias("far"), F.col("keys")[0].alias("first"), "keys")
    best = found.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(hit)), 1, k + 1).alias("best"))
    rows = look_up(asked.select("key", "query"), best, "query").where("best IS NOT NULL")
    singles = F.flatten(F.transform("best", lambda b: F.transform(b["keys"], lambda x: F.struct(b["far"].alias("far"), x.alias("key")))))
    others = F.filter(singles, lambda x: x["key"] != F.col("key"))
    rows = rows.select(F.col("key").alias("query_id"), F.posexplode(F.slice(F.array_sort(others), 1, k)).alias("at", "hit"))
    return rows.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.key").alias(key), (-F.col("hit.far")).alias("score")
    )


def best_entries(have: np.ndarray, want: np.ndarray, firsts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact scores and numbers, (queries, most) each, of the best entries: by cosine, then by first key.

    A product of matrices chooses what is scored exactly. It may order near ties
    differently, so whatever it puts within rounding of the last kept one is scored too.
    """
    near = _unit(want) @ _unit(have).T
    wide = min(4 * most + 16, len(have))
    top = np.argpartition(-near, wide - 1, axis=1)[:, :wide]
    exact = cosine(want[:, None, :], have[top])
    order = np.lexsort((firsts[top], -exact))[:, :most]
    rows = np.arange(len(want))[:, None]
    scores, best = exact[rows, order], top[rows, order]
    last = -np.partition(-near, most - 1, axis=1)[:, most - 1:most]
    tied = near >= last - 4 * (have.shape[1] + 8) * np.finfo(np.float64).eps
    for i in np.flatnonzero(tied.sum(axis=1) > wide):  # more ties than were scored
        own = np.flatnonzero(tied[i])
        exact = cosine(want[i], have[own])
        order = np.lexsort((firsts[own], -exact))[:most]
        scores[i], best[i] = exact[order], own[order]
    return scores, best


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine along the last axis, in double precision."""
    lengths = np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1))
    return (a * b).sum(axis=-1) / lengths


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where part or block change."""
    if len(batch):
        part, block = (batch.column(c).to_numpy() for c in ("part", "block"))
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (block[1:] != block[:-1])) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            yield batch.slice(int(begin), int(end - begin))
