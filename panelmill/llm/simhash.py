"""Near-duplicates by SimHash, compared in bit slices."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.llm.batches import slices
from panelmill.llm.components import components
from panelmill.llm.runs import numbered
from panelmill.llm.shared import map_batches, stored
from panelmill.llm.skew import look_up

BITS = 64
#: Blocks that the bits are cut into. Two fingerprints within the radius agree in all
#: but ``radius`` of them, so they meet in one bucket at least for some choice of the others.
BLOCKS = 6
#: Fingerprints that one task compares with each other; larger buckets are split into tiles.
TILE = 4096
_AT_ONCE = 16
_SMALL = 8
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a text: its words lower-cased in A-Z, hashed by ``shingle`` words, majority by bit."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        runs = zip(*(words[i:] for i in range(shingle)))  # noqa: B905  ends with the shortest
        hashes = map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed))
    hashes = np.fromiter(hashes, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 1 << 14):
        some = hashes[begin:begin + (1 << 14)].astype("<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


class BitPlanes:
    """Fingerprints stored by bit: plane i holds bit i of all of them, 64 to a word."""

    def __init__(self, prints: np.ndarray):
        self.size = len(prints)
        padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
        padded[: len(prints)] = prints
        bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
        self.planes = np.ascontiguousarray(packed).view("<u8")  # (64, words)

    def within(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """(queries, size) booleans: whether a stored fingerprint is within the radius.

        The distances of 64 fingerprints grow together: a step adds two planes of
        differences to counters that are kept as bits (carry-save), and words in
        which all counters have passed the radius are not looked at any more.
        """
        words = self.planes.shape[1]
        asked = np.repeat(np.arange(len(queries)), words)
        word = np.tile(np.arange(words), len(queries))
        digits = radius.bit_length() + 1
        counter = np.zeros((digits, len(asked)), np.uint64)
        over = np.zeros(len(asked), np.uint64)
        near = np.zeros((len(queries), words), np.uint64)
        flips = np.where((queries[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1) == 1, _ALL, np.uint64(0))
        for bit in range(0, BITS, 2):
            a = self.planes[bit][word] ^ flips[asked, bit]
            b = self.planes[bit + 1][word] ^ flips[asked, bit + 1]
            either = a ^ b
            carry = (a & b) | (counter[0] & either)
            counter[0] ^= either
            for d in range(1, digits):
                counter[d], carry = counter[d] ^ carry, counter[d] & carry
            over |= carry
            if bit % 8 == 6:
                past = over | _above(counter, radius)
                live = past != _ALL
                if not live.all():
                    asked, word, over, counter = asked[live], word[live], over[live], counter[:, live]
                if not len(asked):
                    break
        if len(asked):
            near[asked, word] = ~(over | _above(counter, radius))
        found = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : self.size]
        return found.astype(bool)


def _above(counter: np.ndarray, radius: int) -> np.ndarray:
    """Bits set where the counter is above the radius: compared from the highest digit down."""
    above = np.zeros(counter.shape[1], np.uint64)
    equal = np.full(counter.shape[1], _ALL)
    for d in range(len(counter) - 1, -1, -1):
        if radius >> d & 1:
            equal = equal & counter[d]
        else:
            above |= equal & counter[d]
            equal = equal & ~counter[d]
    return above


def forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join the same fingerprints as all pairs within the radius: (fingerprint, another).

    Each fingerprint is asked once, against all that were not asked before, but for those
    that wait and are known to be joined with the askers. So a bucket of near copies takes
    about one comparison for each of them, and a bucket without links all pairs.
    """
    links: list[tuple[int, int]] = []
    group = np.arange(len(prints))  # equal for fingerprints that the links join
    left = np.arange(len(prints))  # not reached yet
    queue = np.zeros(0, np.int64)  # reached, not asked yet
    while len(left) > 0 or len(queue) > 0:
        asking, queue = queue[:_AT_ONCE], queue[_AT_ONCE:]
        more = _AT_ONCE - len(asking)
        asking, left = np.concatenate([asking, left[:more]]), left[more:]
        same = group[asking] == group[asking[0]]
        waiting = queue[group[queue] != group[asking[0]]] if same.all() else queue
        others = np.concatenate([asking, waiting, left])
        if len(others) > 1:
            near = BitPlanes(prints[others]).within(prints[asking], radius)
            for i in np.flatnonzero(near.sum(axis=1) > 1):
                hit = others[near[i]]
                groups, firsts = np.unique(group[hit], return_index=True)
                new = groups != group[asking[i]]
                if new.any():
                    links += [(int(prints[j]), int(prints[asking[i]])) for j in hit[firsts[new]]]
                    group[np.isin(group, groups[new])] = group[asking[i]]
            reached = near[:, len(asking) + len(waiting):].any(axis=0)
            queue, left = np.concatenate([queue, left[reached]]), left[~reached]
    return links


def bucket_links(buckets: np.ndarray, prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within runs of equal bucket numbers; small buckets are compared side by side."""
    begins = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    sizes = np.diff(np.append(begins, len(buckets)))
    links: list[tuple[int, int]] = []
    for b, n in zip(begins[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
        links += forest(prints[b:b + n], radius)
    small = np.repeat(sizes <= _SMALL, sizes)
    buckets, prints = buckets[small], prints[small]
    for step in range(1, min(_SMALL, len(prints))):
        same = buckets[step:] == buckets[:-step]
        if not same.any():
            break
        one, other = prints[step:][same], prints[:-step][same]
        near = BitPlanes(one ^ other).within(np.zeros(1, np.uint64), radius)[0]
        links += zip(one[near].tolist(), other[near].tolist(), strict=True)
    return links


def _bucket_keys(radius: int, blocks: int) -> str:
    """SQL for the bucket numbers of a fingerprint ``fp``: one for each choice of blocks that agree."""
    if blocks <= radius:
        raise ValueError("there must be more blocks than differing bits")
    ends = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << ends[i + 1]) - (1 << ends[i])) for i in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(f"struct({number} AS choice, fp & {signed}L AS part)")
    return f"array({', '.join(keys)})"


def linked(prints: DataFrame, radius: int, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Edges a, b between distinct fingerprints ``fp`` that join the same ones as all pairs within the radius."""
    rows = prints.select("fp", F.inline(F.expr(_bucket_keys(radius, blocks))))
    return linked_in(rows.select("fp", F.xxhash64("choice", "part").alias("bucket")), radius, tile)


def linked_in(rows: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges a, b that join the same ``fp`` as all pairs within the radius that share a ``bucket``."""
    rows = stored(rows, "buckets")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = look_up(rows, sizes, "bucket").where("n IS NOT NULL")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rows = rows.select("fp", "bucket", tiles.alias("tiles"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    rows = rows.select("fp", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple[np.ndarray, np.ndarray]] = []

        def links(final: bool) -> pa.RecordBatch:
            buckets, prints = (np.concatenate(x) for x in zip(*rest, strict=True))
            rest.clear()
            end = len(buckets) if final else int(np.searchsorted(buckets, buckets[-1], "left"))
            if end < len(buckets):  # the last bucket may go on in the next batch
                rest.append((buckets[end:], prints[end:]))
            found = bucket_links(buckets[:end], prints[:end], radius) if end else []
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if len(batch):
                buckets = batch.column("bucket").to_numpy()
                rest.append((buckets, batch.column("fp").to_numpy().view(np.uint64)))
                if buckets[0] != buckets[-1] or len(rest) == 1:
                    yield links(final=False)
        if rest:
            yield links(final=True)

    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    return map_batches(rows, run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, radius: int = 4, shingle: int = 4, key: str = "doc_id", text: str = "text",
    blocks: int = BLOCKS,
) -> DataFrame:
    """Per row: key, fp (64-bit fingerprint), fingerprint (hex) and component_id.

    Rows with fingerprints at most ``radius`` bits apart are linked;
    component_id is the smallest key that links lead to, its own included (null
    keys are passed over). Equal fingerprints are one node, so copies cost
    nothing. Distinct fingerprints are put into buckets by the blocks of bits in
    which two linked ones must agree: every link is found. Buckets above ``TILE``
    are split into tiles that meet pairwise, each bucket yields links that keep
    its fingerprints together instead of all pairs, and components are found
    over those links. More fingerprints call for more ``blocks``: smaller
    buckets, more of them.

    Texts without words, null and empty ones too, have fingerprint 0 and are
    linked like others. Repeated rows get a row each. Other columns are not
    read. An empty table gives no rows.
    """

    rows = _with_prints(docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text")), shingle)
    prints = _components(rows.groupBy("fp").agg(F.min("key").alias("first")), radius, blocks)
    firsts = prints.groupBy("component").agg(F.min("first").alias("component_id"))
    members = look_up(prints.select("fp", "component"), firsts, "component").select("fp", "component_id")
    return look_up(rows, members, "fp").select(
        F.col("key").alias(key), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_prints(rows: DataFrame, shingle: int) -> DataFrame:
    """The columns but ``text``, and the text's fingerprint ``fp``; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            prints = [fingerprint(t, shingle) for t in part.column("text").to_pylist()]
            rest = part.drop_columns(["text"])
            yield rest.append_column("fp", pa.array(np.array(prints, np.uint64).view(np.int64)))

    schema = T.StructType([*[f for f in rows.schema if f.name != "text"], T.StructField("fp", T.LongType())])
    return stored(map_batches(rows, run, schema), "fingerprints")


def _components(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """The distinct fingerprints with their component; stored."""
    prints = stored(prints, "distinct")
    nodes = components(linked(prints.select("fp"), radius, blocks)).withColumnRenamed("node", "fp")
    prints = prints.join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return stored(prints, "components")


def keep_one(
    docs: DataFrame, radius: int = 4, shingle: int = 4, key: str = "doc_id", text: str = "text", blocks: int = BLOCKS
) -> DataFrame:
    """One row, with all its columns, of each group of near-duplicates: one with the group's smallest key.

    Rows with null keys come last. Texts without words, null and empty ones too, are one group, of which
    one row stays, and of repeated rows one stays. An empty table gives no rows. Rows are known by their place in their file, or
    are numbered and stored once, so that the choice also holds for rows that are equal in everything. Only narrow rows go through the
    comparison; at the end the rows that are dropped are taken away.
    """
    source = numbered(docs, key, text)
    rows = _with_prints(source.select("key", "text", "row_id"), shingle)
    rank = F.struct(F.col("key").isNull().alias("late"), "key", "row_id")
    prints = _components(rows.groupBy("fp").agg(F.min(rank).alias("first")), radius, blocks)
    firsts = prints.groupBy("component").agg(F.min("first").alias("chosen"))
    members = look_up(prints.select("fp", "component"), firsts, "component").select("fp", "chosen")
    gone = look_up(rows.select("fp", "row_id"), members, "fp").where(~F.col("row_id").eqNullSafe(F.col("chosen.row_id")))
    kept = source.join(stored(gone.select("row_id"), "dropped"), "row_id", "left_anti")
    return kept.select(*[(F.col("text") if c == text else F.col("row")[f"c{i}"]).alias(c) for i, c in enumerate(docs.columns)])
