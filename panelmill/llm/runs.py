"""Passages in the stream of words that occur again, wherever lines break.

Paragraphs are here all stretches of ``SHINGLE + SPAN - 1`` = 50 words of a text. Each is banded by the
MinHash of its 40-word shingles, one row to a band: two equal paragraphs always meet. Neighbouring paragraphs
mostly share their least shingle, so a text yields one band key in about six words. Colliding
paragraphs hold an equal shingle of 40 words; overlapping ones are put together to the run that they cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.batches import slices
from panelmill.llm.shared import map_batches, stored

#: Words of a shingle, and shingles of a paragraph.
SHINGLE = 40
SPAN = 11
_M = 0x9E3779B97F4A7C15
_BITS = (1 << 64) - 1


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows as key, text, row_id and row, the other columns.

    Rows of Parquet files are known by file and place, so nothing is written; those of other tables are stored
    with a number.
    """
    rest = F.struct(F.lit(0).alias("0"), *[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text])
    columns = docs[key].alias("key"), docs[text].cast("string").alias("text"), rest.alias("row")
    try:
        place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        return docs.select(*columns, place.alias("row_id"))
    except AnalysisException:
        place = F.struct(F.lit(0).cast("bigint").alias("file"), F.monotonically_increasing_id().alias("at"))
        return stored(docs.select(*columns, place.alias("row_id")), "numbered")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words, put together from runs of 1, 2, 4, … words."""
    out, have, power = None, 0, words
    for bit in range(size.bit_length()):
        step = 1 << bit
        if size & step:
            if out is None:
                out = power
            else:
                n = len(words) - have - step + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                out = out[:n] * np.uint64(pow(_M, step, 1 << 64)) + power[have:have + n]
            have += step
        n = len(power) - step
        if n <= 0:
            return _mixed(out) if have == size else np.zeros(0, np.uint64)
        power = power[:n] * np.uint64(pow(_M, step, 1 << 64)) + power[step:step + n]
    return _mixed(out)


def anchors(words: np.ndarray, begins: np.ndarray, size: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the least shingle of each paragraph; ``begins`` are the texts' first words and the end."""
    hashes = shingle_hashes(words, size)
    whole = size + span - 1
    if len(words) < whole:
        return np.zeros(0, np.int64), hashes[:0]
    window = np.lib.stride_tricks.sliding_window_view(hashes, span)
    starts = np.arange(len(window))
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    starts = starts[text[starts] == text[starts + whole - 1]]  # paragraphs do not cross texts
    places = np.unique(starts + window[starts].argmin(axis=1))
    return places, hashes[places]


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts (A-Z lower-cased), and where each text begins and the last ends."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    # a copy that starts at offset zero: lower-casing a cast slice goes wrong
    texts = pa.concat_arrays([texts, pa.array([""], pa.large_string())]).slice(0, len(texts))
    cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    coded = pc.list_flatten(cut).dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    words = known[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.uint64)
    lengths = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    # the trimmed empty text still splits into one empty word
    lengths[pc.binary_length(pc.ascii_trim_whitespace(texts)).to_numpy(zero_copy_only=False) == 0] = 0
    if len(words) != lengths.sum():
        words = words[np.repeat(lengths > 0, np.maximum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), 0))]
    return words, np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])


def band_rows(source: DataFrame, size: int = SHINGLE, span: int = SPAN) -> DataFrame:
    """band, key, row_id and place (the shingle's first word) of all paragraphs of rows (key, text, row_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            words, begins = _words(part.column("text"))
            places, hashes = anchors(words, begins, size, span)
            row = np.searchsorted(begins, places, "right") - 1
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), part.column("key").take(at), part.column("row_id").take(at),
                 pa.array((places - begins[row]).astype(np.int32))],
                names=["band", "key", "row_id", "place"],
            )

    key, row_id = (source.schema[c].dataType.simpleString() for c in ("key", "row_id"))
    return map_batches(source.select("key", "text", "row_id"), run, f"band bigint, key {key}, row_id {row_id}, place int")


def repeated_runs(source: DataFrame, size: int = SHINGLE, span: int = SPAN) -> DataFrame:
    """row_id, key, begin (word), n_words, first_key, first_begin, places (how often it occurs) of what occurs again.

    Of equal shingles the one with the smallest key, then row and place, stays (null keys last); the others are covered.
    A row is a run of covered words without a gap: every stretch of ``size + span - 1`` words that occurs
    earlier lies wholly in what an anchor of it covers or is cut by it, and nothing
    shorter than ``size`` words is covered. Repeats within a text count.

    Counts and first places are combined before they are shuffled, so a passage in a third of all texts is
    one row for each task; the join that finds the others is split where it is skewed.
    """
    rows = stored(band_rows(source, size, span), "bands")
    late = F.col("key").isNull().alias("late")
    place = F.struct(late, "key", "row_id", "place")
    # the second key changes no group; it leaves the join an exchange of its own on both sides, which can be split
    firsts = rows.groupBy("band", F.pmod("band", F.lit(2)).alias("half")).agg(
        F.count(F.lit(1)).alias("places"), F.min(place).alias("first")).where("places > 1").drop("half")
    again = rows.join(firsts, "band").where(~place.eqNullSafe(F.col("first")))
    text = Window.partitionBy("row_id").orderBy("place")  # a text's own shingles
    again = again.withColumn("fresh", F.coalesce(F.col("place") > F.lag("place").over(text) + size, F.lit(True)).cast("int"))
    again = again.withColumn("run", F.sum("fresh").over(text))
    return again.groupBy("row_id", "run").agg(
        F.first("key").alias("key"), F.min("place").alias("begin"), (F.max("place") - F.min("place") + size).alias("n_words"),
        F.min_by("first", "place").alias("first"), F.max("places").alias("places"),
    ).select(
        "row_id", "key", "begin", "n_words", F.col("first.key").alias("first_key"), F.col("first.place").alias("first_begin"), "places"
    )
