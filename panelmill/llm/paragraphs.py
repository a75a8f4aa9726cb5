"""Removal of passages that repeat: paragraph MinHash, banding, exact Jaccard, components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.llm.batches import slices
from panelmill.llm.components import components
from panelmill.llm.runs import numbered, repeated_runs
from panelmill.llm.shared import map_batches, stored
from panelmill.llm.skew import look_up

SHINGLE = 5
SIMILARITY = 0.8
#: Shorter paragraphs are no passages: set phrases, license lines and headings stay.
MIN_WORDS = 50
#: Chance with which two paragraphs of just the least similarity meet in a band.
RECALL = 0.9995
HASHES = 64
#: Paragraphs that one task compares; larger candidate groups are split into tiles.
TILE = 1024


def tuned_bands(similarity: float, recall: float, hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows for a band with which so many hashes reach the recall.

    Two paragraphs of similarity s meet in some band with chance 1 - (1 - s^rows)^bands.
    """
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("too few hashes for the recall")


def passages(text: str | None, min_words: int) -> list[tuple[int, list[bytes]]]:
    """(number of the line, words lower-cased in A-Z) of the lines with enough words."""
    lines = enumerate((text or "").encode().lower().split(b"\n"))
    return [(i, words) for i, line in lines if len(words := line.split()) >= min_words]


def shingles(words: list[bytes], size: int) -> set[bytes]:
    return set(map(b" ".join, zip(*(words[i:] for i in range(size))))) or {b" ".join(words)}  # noqa: B905


def identity(words: list[bytes]) -> int:
    """64 bits for the words; equal for other words with chance n^2 / 2^65 among n texts."""
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def _multipliers(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_501)
    odd = draw.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, hashes, dtype=np.uint64)


def band_keys(flat: np.ndarray, begins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraphs, bands) keys from the shingle hashes of paragraphs that begin at ``begins``."""
    times, plus = _multipliers(bands * rows)
    keys = np.zeros((len(begins), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(begins), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat((flat * times[k] + plus[k]) >> np.uint64(32), begins)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, band] = key
    return keys.view(np.int64)


def similar_links(texts: list[list[bytes]], similarity: float, size: int) -> list[tuple[int, int]]:
    """Numbers of texts whose shingle sets have at least this Jaccard similarity, by an inverted index.

    Enough links to join the same texts as all such pairs: one for each text and each
    set of earlier texts that it joins.
    """
    number: dict[bytes, int] = {}
    postings: list[list[int]] = []
    lengths = np.zeros(len(texts))
    joined = list(range(len(texts)))
    links = []

    def root(x: int) -> int:
        while joined[x] != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        return x

    for i, words in enumerate(texts):
        own = [number.setdefault(s, len(number)) for s in shingles(words, size)]
        postings.extend([] for _ in range(len(number) - len(postings)))
        lengths[i] = len(own)
        met = [postings[s] for s in own if postings[s]]
        if met:
            common = np.bincount(np.concatenate([np.array(p, np.int32) for p in met]), minlength=i)
            near = np.flatnonzero(common >= similarity * (lengths[:i] + len(own) - common) - 1e-9)
            for j in near[common[near] > 0].tolist():
                a, b = root(i), root(j)
                if a != b:
                    joined[max(a, b)] = min(a, b)
                    links.append((i, j))
        for s in own:
            postings[s].append(i)
    return links


def _with_bands(docs: DataFrame, min_words: int, size: int, bands: int, rows: int) -> DataFrame:
    """key, row_id, paragraph, n_words, text_id and bands of every passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            at, line, n_words, ids, hashes, counts = [], [], [], [], [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                for number, words in passages(text, min_words):
                    own = list(map(xxhash.xxh64_intdigest, shingles(words, size)))
                    at.append(i)
                    line.append(number)
                    n_words.append(len(words))
                    ids.append(identity(words))
                    hashes.extend(own)
                    counts.append(len(own))
            if not at:
                continue
            begins = np.cumsum(counts) - counts
            keys = band_keys(np.array(hashes, np.uint64), begins, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(pa.array(at)), part.column("row_id").take(pa.array(at)),
                    pa.array(line, pa.int32()), pa.array(n_words, pa.int32()),
                    pa.array(ids, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * bands), pa.array(keys.ravel())),
                ],
                names=["key", "row_id", "paragraph", "n_words", "text_id", "bands"],
            )

    kind, row_id = (docs.schema[c].dataType.simpleString() for c in ("key", "row_id"))
    return map_batches(docs.select("key", "text", "row_id"), run, f"key {kind}, row_id {row_id}, paragraph int, n_words int, text_id bigint, bands array<bigint>")


def _colliding(nodes: DataFrame) -> DataFrame:
    """Edges a, b from each text to the first of each band bucket that it shares with other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # band and first text of the run that may go on
        for batch in batches:
            if not len(batch):
                continue
            band, text = (batch.column(c).to_numpy() for c in ("band", "text_id"))
            new = np.concatenate([[last is None or band[0] != last[0]], band[1:] != band[:-1]])
            run_of = np.cumsum(new)  # 0: goes on from the last batch
            firsts = np.concatenate([[last[1] if last else 0], text[new]])
            first = firsts[run_of]
            last = (band[-1], first[-1])
            link = text != first
            yield pa.RecordBatch.from_arrays([pa.array(text[link]), pa.array(first[link])], names=["a", "b"])

    rows = nodes.select("text_id", F.explode("bands").alias("band"))
    rows = rows.repartition("band").sortWithinPartitions("band", "text_id")
    return map_batches(rows, run, "a bigint, b bigint").distinct()


def _verified(docs: DataFrame, found: DataFrame, candidates: DataFrame, min_words: int, size: int, similarity: float, tile: int) -> DataFrame:
    """Edges a, b between candidates (node, component) that really are so similar."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            own: dict[int, bytes] = {}
            for t, wanted in zip(part.column("text").to_pylist(), part.column("wanted").to_pylist(), strict=True):
                ids = set(wanted)
                own |= {i: b" ".join(w) for _, w in passages(t, min_words) if (i := identity(w)) in ids}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.binary())], names=["text_id", "words"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
            found = similar_links([w.split(b" ") for _, w in rows], similarity, size)
            ends = [pa.array([rows[x[k]][0] for x in found], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        group, rows = None, []
        for batch in batches:
            groups, ids = batch.column("grp").to_pylist(), batch.column("text_id").to_pylist()
            for g, i, w in zip(groups, ids, batch.column("words").to_pylist(), strict=True):
                if g != group and rows:
                    yield links(rows)
                    rows = []
                group = g
                rows.append((i, w))
        if rows:
            yield links(rows)

    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    tiles = F.ceil(F.col("n") / tile).cast("int")
    placed = look_up(candidates, sizes, "component").select(
        F.col("node").alias("text_id"), "component", tiles.alias("tiles"),
        F.pmod(F.xxhash64("node"), tiles).cast("int").alias("own"),
    )
    # one row for each candidate is read, and only candidates leave the scan's texts
    sample = found.join(candidates.select(F.col("node").alias("text_id")), "text_id", "left_semi")
    sample = sample.groupBy("text_id").agg(F.min("row_id").alias("row_id")).groupBy("row_id").agg(F.collect_list("text_id").alias("wanted"))
    words = map_batches(docs.join(sample, "row_id").select("text", "wanted"), texts, "text_id bigint, words binary")
    rows = placed.join(words, "text_id").withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    group = F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select(group.alias("grp"), "text_id", "words").repartition("grp").sortWithinPartitions("grp", "text_id")
    return map_batches(rows, compare, "a bigint, b bigint").distinct()


def repeated_passages(
    docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, shingle: int = SHINGLE,
    recall: float = RECALL, hashes: int = HASHES, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every passage that occurs again, exactly or nearly: a row per occurrence.

    A passage is a line of at least ``min_words`` words, compared without regard
    to case in A-Z and to white space. Two belong together if the Jaccard similarity of
    their sets of five-word shingles is at least ``similarity``, directly or over
    others. Columns: key, paragraph (number of the line, from 0), n_words,
    first_key and first_paragraph (the occurrence that stays: the one with the
    smallest key, then line; nulls last), cluster_size and removed, which is false
    for one occurrence only, also where rows are equal in key and line.

    Equal passages are one node. MinHash signatures are cut into as few bands as
    reach the recall for passages of just that similarity; passages that share
    a band form candidate groups, and inside a group exact Jaccard decides.
    Groups above ``TILE`` are split into tiles that meet pairwise, so no pair is
    lost; links, not pairs, leave a task, and clusters are their components.

    Null and empty texts have no passages. Rows with the same key are parts of
    one document. Null keys take part. Repeats within a document count. Other
    columns are not read. An empty table gives no rows.
    """
    source = docs.select(
        docs[key].alias("key"), docs[text].cast("string").alias("text"), F.monotonically_increasing_id().alias("row_id")
    )
    return _repeats(source, similarity, min_words, shingle, recall, hashes).select(
        F.col("key").alias(key), "paragraph", "n_words", F.col("first.key").alias(f"first_{key}"),
        F.col("first.paragraph").alias("first_paragraph"), "cluster_size", "removed", "text_id",
    )


def _repeats(
    source: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, shingle: int = SHINGLE,
    recall: float = RECALL, hashes: int = HASHES,
) -> DataFrame:
    """The repeated passages of rows (key, text, row_id), each with the occurrence ``first`` that stays."""
    bands, rows = tuned_bands(similarity, recall, hashes)
    found = stored(_with_bands(source, min_words, shingle, bands, rows), "passages")
    nodes = found.select("text_id", "bands").groupBy("text_id").agg(F.first("bands").alias("bands"))
    candidates = stored(components(_colliding(nodes)), "candidates")
    verified = _verified(source, found, candidates, min_words, shingle, similarity, TILE)
    clusters = components(verified)
    thin = found.select("key", "row_id", "paragraph", "n_words", "text_id")
    thin = look_up(thin, clusters.withColumnRenamed("node", "text_id"), "text_id")
    thin = stored(thin.withColumn("cluster", F.coalesce("component", "text_id")).drop("component"), "occurrences")
    place = F.struct(F.col("key").isNull().alias("late"), "key", "paragraph", "row_id")
    groups = thin.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"), F.min(place).alias("first")).where("cluster_size > 1")
    members = look_up(thin, groups, "cluster").where("cluster_size IS NOT NULL")
    stays = (F.col("row_id") == F.col("first.row_id")) & (F.col("paragraph") == F.col("first.paragraph"))
    return members.withColumn("removed", ~stays)


def passages_again(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Every passage that occurs again, in lines or in the stream of words: a row per occurrence.

    Lines of at least 50 words, exactly or nearly equal, as ``repeated_passages`` has them, with kind ``line`` and place, the number
    of the line; and runs of equal words that go over lines or stop inside them, with kind ``run`` and place, the first word (see
    ``runs``). Columns: key, kind, place, n_words, first_key and first_place (the occurrence that stays), cluster_size
    and removed. For runs only those that go are told.

    Null and empty texts have no passages. Repeated rows are occurrences of their own. Null keys come last. Other columns
    are not read. An empty table gives no rows.
    """
    source = numbered(docs.select(docs[key].alias("key"), docs[text].alias("text")), "key", "text")
    lines = _repeats(source, **options).select(
        "key", F.lit("line").alias("kind"), F.col("paragraph").alias("place"), "n_words", F.col("first.key").alias("first_key"),
        F.col("first.paragraph").alias("first_place"), "cluster_size", "removed",
    )
    runs = repeated_runs(source).select(
        "key", F.lit("run").alias("kind"), F.col("begin").alias("place"), "n_words", "first_key",
        F.col("first_begin").alias("first_place"), F.col("places").alias("cluster_size"), F.lit(True).alias("removed"),
    )
    return lines.unionByName(runs).withColumnsRenamed({"key": key, "first_key": f"first_{key}"})


_SEEN = re.compile(rb"[^\x20\x09-\x0D]+")


def cut_out(text: str, lines: list[int], runs: list[tuple[int, int]]) -> str:
    """The text without some lines (by number) and runs of words (first, how many); what is left stands on lines of its own."""
    data = text.encode()
    spans = []
    if lines:
        ends = np.cumsum([len(x) + 1 for x in data.split(b"\n")])
        spans += [(int(ends[i - 1]) if i else 0, int(ends[i])) for i in lines]
    if runs:
        words = [m.span() for m in _SEEN.finditer(data)]
        spans += [(words[begin][0], words[begin + n - 1][1]) for begin, n in runs]
    left, at = [], 0
    for begin, end in [*sorted(spans), (len(data), len(data))]:
        if begin > at:
            left.append(data[at:begin])
        at = max(at, end)
    left = [x for x in left if x.strip()]
    return b"\n".join(x.strip(b"\n") for x in left).decode()


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns, each passage left only where it occurs first.

    Documents of which nothing but white space is left are dropped. Null and empty texts stay as they are, and repeated rows stay
    without their passages, or go where nothing else is in them. Each text is shuffled once, to meet what
    is cut from it; rows of Parquet files are not copied.
    """
    rows = numbered(docs, key, text)
    source = rows.select("key", "text", "row_id")
    lines = _repeats(source, **options).where("removed").groupBy("row_id").agg(F.collect_set("paragraph").alias("lines"))
    runs = repeated_runs(source).groupBy("row_id").agg(F.collect_set(F.struct("begin", "n_words")).alias("runs"))
    cuts = lines.join(runs, "row_id", "full")  # a row's own passages
    rows = rows.join(cuts, "row_id", "left").select("row", "text", "lines", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            keep = []
            for i, (gone, spans) in enumerate(zip(part.column("lines").to_pylist(), part.column("runs").to_pylist(), strict=True)):
                if gone or spans:
                    texts[i] = cut_out(texts[i], gone or [], [(r["begin"], r["n_words"]) for r in spans or []])
                    if not texts[i].strip():
                        continue
                keep.append(i)
            kept = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(kept), pa.array(texts, pa.string()).take(kept)], names=["row", "text"]
            )

    out = map_batches(rows, run, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    return out.select(*[
        (F.col("text") if c == text else F.col("row")[f"c{i}"]).alias(c) for i, c in enumerate(docs.columns)
    ])
