"""Token ids in binary shards with a minimal perfect hash index.

A shard is two files in a shared folder. ``….ids`` holds the ids of its documents
one after the other as little-endian integers of 2 bytes (4, if the vocabulary
needs them), nothing else. ``….idx`` is an uncompressed npz archive:

* ``tokens``: ids per document, in file order; ``keys``: their keys (0 for null);
* ``nulls``: how many documents at the front have a null key;
* ``level_words``, ``level_sizes``: the bits of the hash's levels;
* ``fingerprint``, ``first``, ``count``: by slot, 32 bits of another hash of the key, the
  number of the key's first document, and of how many documents it is the key.

A key is found in constant time: its slot by the hash, the check of the
fingerprint (a foreign key passes once in 2^32), the offset by the running sum.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelmill.llm.batches import slices
from panelmill.llm.chunks import coder
from panelmill.llm.shared import file_system, map_batches, new_folder, stored

SHARD_TOKENS = 16 << 20
MOST_TASKS = 20_000
MANIFEST = "shard bigint, path string, width int, documents bigint, tokens bigint, low {key}, high {key}"
DOCUMENTS = "key {key}, start bigint, n_tokens bigint, ids binary"
_CHECK = 1 << 20  # the hash's seed for fingerprints, above those of the levels


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key; for one seed, different keys give different bits."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 … n-1 for n different keys.

    At each level the keys that are left are hashed to twice as many bits; a key
    alone at its bit is placed there, the others go on to the next level. The
    slot is the number of set bits before the key's own.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words, self.sizes = words, sizes  # all levels' bits; bits per level
        self.starts = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        words, sizes = [np.zeros(0, np.uint64)], []
        while len(keys):
            size = 64 * (-(-2 * len(keys) // 64))
            at = (_mix(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(np.concatenate(words), np.array(sizes, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not built in gets any slot or -1."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts, self.sizes, strict=True)):
            at = start + (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[left[here]] = (self.before[at >> 6] + below)[here]
            left = left[~here]
            if not len(left):
                break
        return found


class Shard:
    """Keyed access to one shard: reads its index at once and of the ids what is asked for."""

    def __init__(self, path: str, width: int):
        system, inner = file_system(path)
        with system.open_input_stream(f"{inner}.idx") as file:
            index = dict(np.load(io.BytesIO(file.read())))
        self.keys, self.tokens, self.nulls = index["keys"], index["tokens"], int(index["nulls"])
        self.hash = PerfectHash(index["level_words"], index["level_sizes"])
        self.fingerprint, self.first, self.count = index["fingerprint"], index["first"], index["count"]
        self.offset = np.concatenate([[0], np.cumsum(self.tokens)])
        self.width = width
        self.file = system.open_input_file(f"{inner}.ids")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the first document of each key, and how many it has (0: not in the shard)."""
        slot = self.hash.slots(keys)
        known = slot >= 0
        known[known] = self.fingerprint[slot[known]] == _fingerprint(keys[known])
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known], count[known] = self.first[slot[known]], self.count[slot[known]]
        return first, count

    def ids(self, document: int) -> np.ndarray:
        self.file.seek(int(self.offset[document]) * self.width)
        raw = self.file.read(int(self.tokens[document]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, _CHECK) >> np.uint64(32)).astype(np.uint32)


def _index(keys: np.ndarray, null: np.ndarray, tokens: np.ndarray) -> bytes:
    """The index of a shard whose documents are in ascending order of key, nulls first."""
    nulls = int(null.sum())
    distinct, first, count = np.unique(keys[nulls:], return_index=True, return_counts=True)
    hashed = PerfectHash.build(distinct)
    slot = hashed.slots(distinct)
    by_slot = np.argsort(slot)
    out = io.BytesIO()
    np.savez(
        out, keys=keys, tokens=tokens, nulls=nulls, level_words=hashed.words, level_sizes=hashed.sizes,
        fingerprint=_fingerprint(distinct)[by_slot], first=(first + nulls)[by_slot], count=count[by_slot],
    )
    return out.getvalue()


def write_store(
    docs: DataFrame, folder: str, path: str, end_id: int = 2, kind: str = "byte",
    key: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Write all documents in ascending order of their key, and return the manifest: a row per shard.

    Each document is its ids and the end id. The rows are range-partitioned and
    sorted by key (ties by text), encoded and written by the tasks; a partition
    is a run of shards of about ``shard_tokens`` ids, or one longer document.
    Shards carry the attempt in their names and only those of successful tasks
    are in the manifest, so a task that is run again does no harm. Memory is
    bounded by a block of text and the numbers of a shard's documents.

    The key must be an integer column; null keys come first. Rows with the same
    key stay together and are all found by it. A null text is just the end id.
    Other columns are not read. An empty table gives an empty manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        code = coder(kind, path)
        width = 2 if code.vocabulary <= 1 << 16 and end_id < 1 << 16 else 4
        system, inner = file_system(folder)
        shard, out, pending, written = context.partitionId() << 24, None, [], 0

        def close() -> pa.RecordBatch:
            keys = np.concatenate([x[0] for x in pending])
            null = np.concatenate([x[1] for x in pending])
            tokens = np.concatenate([x[2] for x in pending])
            out.close()
            with system.open_output_stream(f"{inner}/{name}.idx") as file:
                file.write(_index(keys, null, tokens))
            known = keys[~null]
            ends = [int(known[0]), int(known[-1])] if len(known) else [None, None]
            row = [shard, f"{folder}/{name}", width, len(keys), int(tokens.sum()), *ends]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), key_type, key_type], strict=True)],
                names=["shard", "path", "width", "documents", "tokens", "low", "high"],
            )

        for part in slices(batches, "text"):
            key_type = part.schema.field("key").type
            flat, begins = code.encode(part.column("text"))
            if out is None:
                name = f"{shard:012d}-{context.taskAttemptId()}"
                out = system.open_output_stream(f"{inner}/{name}.ids")
            tokens = np.diff(begins) + 1
            out.write(np.insert(flat, begins[1:], end_id).astype(f"<u{width}").tobytes())
            keys = part.column("key")
            pending.append((
                keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                keys.is_null().to_numpy(zero_copy_only=False), tokens,
            ))
            written += int(tokens.sum())
            if written >= shard_tokens:
                yield close()
                shard, out, pending, written = shard + 1, None, [], 0
        if out is not None:
            yield close()

    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    rows = rows.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    kind_of_key = rows.schema["key"].dataType.simpleString()
    return stored(map_batches(rows, run, MANIFEST.format(key=kind_of_key)), "manifest")


def read_store(manifest: DataFrame) -> DataFrame:
    """Every document of a store: key, start (ids before it in the whole store), n_tokens and ids (32-bit).

    Each document is fetched by its key through the index. The running sum over
    shards is a window over the manifest alone: a row per shard.
    """
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", "path", "width", "low", F.coalesce(before, F.lit(0)).alias("base"))
    shards = shards.repartition(min(max(1, manifest.count()), MOST_TASKS), "shard")
    key_type = manifest.schema["low"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"], row["width"])
                keys = shard.keys[shard.nulls:]
                distinct = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
                first, count = shard.find(distinct)
                numbers = [(None, i) for i in range(shard.nulls)]
                numbers += [
                    (k, i) for k, f, n in zip(distinct.tolist(), first.tolist(), count.tolist(), strict=True)
                    for i in range(f, f + n)
                ]
                for begin in range(0, len(numbers), 1000):
                    some = numbers[begin:begin + 1000]
                    at = [i for _, i in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k for k, _ in some], batch.schema.field("low").type),
                            pa.array(row["base"] + shard.offset[at]), pa.array(shard.tokens[at]),
                            pa.array([shard.ids(i).tobytes() for i in at], pa.binary()),
                        ],
                        names=["key", "start", "n_tokens", "ids"],
                    )

    return map_batches(shards, run, DOCUMENTS.format(key=key_type))


def fetch(spark: SparkSession, manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of the given keys: key, n_tokens, ids; a row for each document of each distinct key.

    Keys go to the shards whose range holds them (ranges share their ends at
    most), each shard is opened once and read at the asked documents. The ranges
    are collected: three values for each shard of 16 million ids. Keys that the
    store lacks, and nulls, give no rows.
    """
    wanted = keys.select(keys[key].alias("key")).where("key IS NOT NULL").distinct()
    shards = manifest.where("low IS NOT NULL").orderBy("shard").select("path", "width", "low", "high").collect()
    lows, highs = (np.array([s[c] for s in shards], np.int64) for c in ("low", "high"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64)
            begin, end = np.searchsorted(highs, asked, "left"), np.searchsorted(lows, asked, "right")
            many = np.maximum(end - begin, 0)
            at = np.repeat(np.arange(len(asked)), many)
            to = np.concatenate([np.arange(b, e) for b, e in zip(begin, end, strict=True)]) if len(at) else at
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at)), pa.array([shards[i]["path"] for i in to], pa.string()), pa.array([shards[i]["width"] for i in to], pa.int32())],
                names=["key", "path", "width"],
            )

    kind = wanted.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, path = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    path, shard = row["path"], Shard(row["path"], row["width"])
                first, count = shard.find(np.array([row["key"]], np.int64))
                for i in range(int(first[0]), int(first[0] + count[0])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["key"]], batch.schema.field("key").type), pa.array([int(shard.tokens[i])], pa.int64()), pa.array([shard.ids(i).tobytes()], pa.binary())],
                        names=["key", "n_tokens", "ids"],
                    )

    met = map_batches(wanted, route, f"key {kind}, path string, width int").repartition("path").sortWithinPartitions("path", "key")
    return map_batches(met, run, f"key {kind}, n_tokens bigint, ids binary").withColumnRenamed("key", key)


