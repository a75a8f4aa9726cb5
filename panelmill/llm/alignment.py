"""Alignment of two tokenizers over the same texts, in Arrow columns.

A stage is one pass over batches: token ids are list columns that are flattened
with their parents, byte ends are segmented cumulative sums, ends that both
tokenizers share come from a hash join on document-end keys, and pair counts are
partial counts of a grouped table that Spark merges.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.batches import slices
from panelmill.llm.chunks import ChunkCoder, merged, spaced
from panelmill.llm.shared import map_batches, stored

#: Bytes of text that are aligned at a time (or one longer text).
BLOCK_BYTES = 1 << 20
#: Links that are counted or looked up at a time (or those of one longer text).
BLOCK_LINKS = 1 << 19
#: Chunks of a table that are kept for the next block.
KEPT = 200_000
_START = "\x02"
_MARKER = "▁"


class SpacedBytes(ChunkCoder):
    """Ids of a space and the text by a byte-level vocabulary; special strings in texts are plain text."""

    def __init__(self, path: str):
        super().__init__("byte", path, KEPT)
        self.model.encode_special_tokens = True
        self.uneven = f"{self.whole}|{self.runs}"
        self.spaced = False

    def _as_chunks(self, pieces: pa.Array) -> pa.Array:
        """The first chunk of a text whose words stand one space apart gets its space here."""
        if not self.spaced:
            return super()._as_chunks(pieces)
        return pc.replace_substring(pc.replace_substring(spaced(pieces), " \n", "\n"), _START, "")

    def encode_spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        uneven = pc.match_substring_regex(texts, self.uneven)
        self.spaced = True
        even = self.encode(texts.filter(pc.invert(uneven)))
        self.spaced = False
        other = self.encode(spaced(texts.filter(uneven)))
        if not len(other[1]) > 1:
            return even
        ids, counts = merged(uneven.to_numpy(zero_copy_only=False), *((ids, np.diff(begins)) for ids, begins in (even, other)))
        return ids, np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    from tokenizers import Tokenizer

    model, letters = Tokenizer.from_file(path), _byte_alphabet()
    added = {i: t.content for i, t in model.get_added_tokens_decoder().items()}
    out = []
    for i in range(model.get_vocab_size()):
        token = model.id_to_token(i) or ""
        out.append(added[i].encode() if i in added else bytes(letters[c] for c in token))
    return out


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a piece model; the marker is a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_MARKER, " ").encode() for i, p in enumerate(names)]


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many different pairs of ids can ever be linked: of two tokens that end together one ends with the other."""
    return sum(
        sum(there[token[i:]] for i in range(begin, len(token)))
        for tokens, other, begin in ((a, b, 0), (b, a, 1))
        for there in [Counter(other)] for token in tokens
    )


class Aligner:
    """The worker's tokenizers and the bytes, lengths and decimal names of their ids."""

    def __init__(self, byte_path: str, piece_path: str):
        self.coders = SpacedBytes(byte_path), ChunkCoder("piece", piece_path, KEPT)
        self.encode = self.coders[0].encode_spaced, self.coders[1].encode
        tokens = byte_tokens(byte_path), piece_tokens(piece_path)
        self.bytes = [pa.array(t, pa.large_binary()) for t in tokens]
        self.lengths = [pa.array([len(x) for x in t], pa.int64()) for t in tokens]
        self.names = [pa.array([str(i) for i in range(len(t))], pa.large_string()) for t in tokens]
        self.pieces = len(tokens[1])

    def tokens(self, texts: pa.Array) -> list[pa.Array]:
        """Lists of ids, one array for each tokenizer."""
        return [
            pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(ids.astype(np.int32)))
            for ids, begins in (encode(texts) for encode in self.encode)
        ]

    def joined(self, ids: pa.Array, side: int) -> pa.Array:
        """The bytes of each list's tokens, joined."""
        found = pa.LargeListArray.from_arrays(ids.offsets, self.bytes[side].take(ids.values))
        return pc.binary_join(found, pa.scalar(b"", pa.large_binary()))

    def ends(self, ids: pa.Array, side: int, base: np.ndarray) -> pa.Table:
        """Per token: its document-end key (bytes of earlier texts plus its own end), position and id.

        The sum runs on over all texts; taking away what it had reached at the
        token's parent makes it the end within the text.
        """
        flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids).to_numpy(zero_copy_only=False)
        run = pc.cumulative_sum(self.lengths[side].take(flat)).to_numpy(zero_copy_only=False)
        begins = ids.offsets.to_numpy(zero_copy_only=False)[:-1]
        reached = np.concatenate([np.zeros(1, np.int64), run])[begins]
        key = run - reached[parent] + base[parent]
        return pa.table({"key": key, f"at{side}": np.arange(len(flat)), f"id{side}": flat})

    def align(self, texts: pa.Array) -> dict[str, pa.Array | np.ndarray]:
        """Columns for texts that are neither null nor empty."""
        want = pc.cast(spaced(texts), pa.large_binary())
        ids = self.tokens(texts)
        same = pc.and_(*[pc.equal(self.joined(x, side), want) for side, x in enumerate(ids)])
        at = np.flatnonzero(same.to_numpy(zero_copy_only=False))
        ids, want = [x.filter(same) for x in ids], want.filter(same)
        size = pc.binary_length(want).to_numpy(zero_copy_only=False).astype(np.int64)
        base = np.cumsum(size) - size
        a, b = (self.ends(x, side, base) for side, x in enumerate(ids))
        links = a.join(b, "key", join_type="inner", use_threads=False).sort_by("key")
        key = links["key"].to_numpy()
        per_text = np.diff(np.searchsorted(key, np.concatenate([base, [base[-1] + size[-1]]]), "right")) if len(at) else np.zeros(0, np.int64)
        groups = []
        for side, x in enumerate(ids):
            cuts = np.concatenate([np.zeros(1, np.int64), links[f"at{side}"].to_numpy() + 1])
            names = pa.LargeListArray.from_arrays(pa.array(cuts), self.names[side].take(pc.list_flatten(x)))
            groups.append(pc.binary_join(names, pa.scalar(",", pa.large_string())))
        begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_text)])
        both = pc.binary_join_element_wise(*groups, pa.scalar("|", pa.large_string()))
        whole = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(begins), both), pa.scalar(";", pa.large_string()))
        pair = links["id0"].to_numpy().astype(np.int64) * self.pieces + links["id1"].to_numpy()
        counts = [pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in ids]
        return {
            "at": at, "n_a": counts[0], "n_b": counts[1], "n_groups": per_text, "pair": pair,
            "sha": [sha256(x.as_buffer()).hexdigest() for x in whole],
        }


    def forget(self) -> None:
        """Give back what Arrow holds in reserve between two blocks."""
        pa.default_memory_pool().release_unused()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _ALIGNERS:
        _ALIGNERS[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _ALIGNERS[byte_path, piece_path]


def aligned(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, groups_sha256 and links, the pairs (a * pieces + b) in the order of their ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _aligner(byte_path, piece_path)
        for part in slices(batches, "text", BLOCK_BYTES):
            texts = part.column("text").cast(pa.large_string())
            full = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
            places = np.flatnonzero(full.to_numpy(zero_copy_only=False))
            columns = {c: np.zeros(len(part), np.int64) for c in ("n_a", "n_b", "n_groups")}
            sha, pair = np.full(len(part), "", object), np.zeros(0, np.int64)
            if len(places):
                found = code.align(texts.filter(full))
                at, pair = places[found["at"]], found["pair"]
                for c, values in columns.items():
                    values[at] = found[c]
                sha[at] = found["sha"]
                code.forget()
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(columns["n_groups"])])
            links = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(pair, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *map(pa.array, columns.values()), pa.array(sha, pa.string()), links],
                names=["key", *columns, "groups_sha256", "links"],
            )

    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(
        rows, run, f"key {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<bigint>"
    )


def pair_counts(links: DataFrame, pieces: int) -> DataFrame:
    """pair, n (links in the corpus) and best (n is the highest of the pair's b) from a column ``links``.

    Each task counts its own pairs in a table that holds a pair once; Spark adds up the tasks' counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        for part in slices(batches, "links", BLOCK_LINKS, pc.list_value_length):
            flat = pa.table({"pair": pc.list_flatten(part.column("links"))})
            some = flat.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
            both = pa.concat_tables([total, some.select(["pair", "n"])])
            total = both.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
        yield from total.select(["pair", "n"]).to_batches()

    counts = map_batches(links.select("links"), run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    b = Window.partitionBy(F.col("pair") % pieces)  # at most the pairs that the vocabularies allow
    return counts.withColumn("best", F.col("n") == F.max("n").over(b))


def alignment(
    docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A is the byte-level vocabulary over a space and the text, B the piece model over the text. Where
    tokens of both end at one byte a group ends, and the two tokens are linked. A pair of ids counts as often as the whole
    corpus links it: n_best is the number of a row's links whose pair counts most among those of its B id, count_sum
    the sum of the counts over a row's links.

    Null and empty texts, and those whose tokens do not spell a space and the text (a text with the
    piece marker itself), have no tokens: zeros and an empty groups_sha256. Repeated rows count each time and
    each give a row; null keys too. Other columns are not read. An empty table gives no rows.
    Texts are read and encoded once. The pair counts go to all tasks: their number has a bound that
    the vocabularies set, ``most_pairs`` (0.5 million for the usual sizes).
    """
    rows = stored(aligned(docs, byte_path, piece_path, key, text), "alignment")
    a, b = byte_tokens(byte_path), piece_tokens(piece_path)
    table = pair_counts(rows, len(b)).toArrow().sort_by("pair")
    if table.num_rows > most_pairs(a, b):
        raise RuntimeError("more pairs than the vocabularies can link")
    counts = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {c: pc.cast(counts.value[c], pa.int64()).to_numpy() for c in ("pair", "best", "n")}
        for part in slices(batches, "links", BLOCK_LINKS, pc.list_value_length):
            links = part.column("links")
            at = np.searchsorted(known["pair"], pc.list_flatten(links).to_numpy(zero_copy_only=False))
            n_links = pc.list_value_length(links).cast(pa.int64())
            begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(n_links.to_numpy(zero_copy_only=False))])
            n_best, total = (np.diff(np.concatenate([np.zeros(1, np.int64), np.cumsum(known[c][at])])[begins]) for c in ("best", "n"))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ("key", "n_a", "n_b", "n_groups")], n_links, pa.array(n_best), pa.array(total),
                 part.column("groups_sha256")],
                names=["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    out = map_batches(rows, run, (
        f"key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    ))
    return out.withColumnRenamed("key", key)
