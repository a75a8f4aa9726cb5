"""Packing of documents into sequences by multiway differencing."""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from panelmill.llm.batches import slices
from panelmill.llm.chunks import coder
from panelmill.llm.shared import map_batches

#: Documents are packed in groups of about so many tokens: 512 sequences of 4096.
GROUP_TOKENS = 2 << 20
PIECES = (
    "key {key}, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, `offset` bigint"
)


def _difference(lengths: list[int], ways: int) -> list[list[int]]:
    """Largest differencing: near-equal parts of the items, by merging partial partitions.

    A partial partition has ``ways`` parts; only the parts with items are stored,
    as (sum, number, items) in ascending order. The two with the largest spread
    are merged, the largest part of one with the smallest of the other, until one
    is left. What all parts share is taken off the sums, as only differences count.
    """
    heap = [(-n, i, [(n, i, [i])]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(one) < len(other):
            one, other = other, one
        # parts of the other, largest first, take the empty parts of this one, then its smallest
        free = ways - len(one)
        falling = other[::-1]
        shared = falling[free:]
        merged = one[len(shared):]
        for (a, i, x), (b, _, y) in zip(one, shared):  # noqa: B905  shared is the shorter
            insort(merged, (a + b, i, x + y))
        for part in falling[:free]:
            insort(merged, part)
        if len(merged) == ways and (least := merged[0][0]):
            merged = [(a - least, i, x) for a, i, x in merged]
        spread = merged[-1][0] - (merged[0][0] if len(merged) == ways else 0)
        heapq.heappush(heap, (-spread, made, merged))
        made += 1
    return [x for _, _, x in heap[0][2]] if heap else []


def windows(lengths: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the items in each window: the fewest near-equal windows that keep to the capacity.

    Starts from the smallest number of windows that could do and adds one as long
    as differencing leaves a window above the capacity. No item may exceed it.
    """
    ways = -(-sum(lengths) // capacity)
    while True:
        parts = _difference(lengths, ways)
        if all(sum(lengths[i] for i in part) <= capacity for part in parts):
            return parts
        ways += 1


def pack(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, kind: str = "word",
    key: str = "doc_id", text: str = "text", group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Each document is its ids and the end id. Documents above the capacity are cut
    into full sequences and a rest; rests and shorter documents are packed by
    differencing, in groups of about ``group_tokens`` tokens that a task gathers
    from its own rows, so nothing is shuffled and memory is bounded by a group and
    the longest document. Near-equal windows waste at most about one window in a
    group. A sequence is meant to be padded to the capacity; no ids for padding
    are returned. sequence_id is the partition's number * 2^33 and a running
    number; a repeated task gives the same ids to the same rows.

    A null or empty text is just the end id. Repeated rows and null or repeated
    keys are packed one by one. Other columns are not read. An empty table gives
    no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(kind, path)
        sequence = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []  # key, start, ids, tokens of the document
        tokens = 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            keys, start, ids, total, number, offset = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, key_type), pa.array(start, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                    pa.array(total, pa.int64()), pa.array(number, pa.int64()), pa.array(offset, pa.int64()),
                ],
                names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for window in windows([len(x[2]) for x in waiting], capacity):
                at = 0
                for i in window:
                    rows.append((*waiting[i], sequence, at))
                    at += len(waiting[i][2])
                sequence += 1
            waiting.clear()
            return batch(rows)

        key_type = None
        for part in slices(batches, "text"):
            key_type = part.schema.field("key").type
            flat, begins = code.encode(part.column("text"))
            full = []
            for k, b, e in zip(part.column("key").to_pylist(), begins[:-1], begins[1:], strict=True):
                ids = np.append(flat[b:e], np.uint32(end_id)).astype("<u4")
                cut = len(ids) - len(ids) % capacity
                for start in range(0, cut, capacity):
                    full.append((k, start, ids[start:start + capacity], len(ids), sequence, 0))
                    sequence += 1
                if cut < len(ids):
                    waiting.append((k, cut, ids[cut:], len(ids)))
                    tokens += len(ids) - cut
                if tokens >= group_tokens:
                    yield packed()
                    tokens = 0
            if full:
                yield batch(full)
        if waiting:
            yield packed()

    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    out = map_batches(rows, run, PIECES.format(key=rows.schema["key"].dataType.simpleString()))
    return out.withColumnRenamed("key", key)
