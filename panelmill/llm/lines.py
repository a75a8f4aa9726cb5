"""Removal of lines that many documents hold: range-partitioned hashes, streamed in order.

Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.shared import stored

#: Lines that count: so many code points after stripping, in so many documents.
MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Line keys with more than one in so many of all lines are hot, so there are fewer of them than this.
HOT_SHARE = 4096
#: Leading bits of the hash by which lines are counted in search of hot keys.
RANGE_BITS = 16


def _key(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_hashes(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """key, text_id, n_lines, position and 128 hash bits (high, low) of every line that counts."""
    value = F.coalesce(docs[text].cast("string"), F.lit(""))
    lines = docs.select(
        docs[key].alias("key"), F.xxhash64(value).alias("text_id"),
        F.split(F.translate(value, UPPER, LOWER), "\n").alias("lines"),
    )
    lines = lines.select("key", "text_id", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("position", "line"))
    lines = lines.withColumn("line", _key(F.col("line"))).where(F.char_length("line") >= min_chars)
    hashes = F.xxhash64("line").alias("high"), F.xxhash64(F.lit("low"), "line").alias("low")
    return lines.select("key", "text_id", "n_lines", "position", *hashes)


def hot_keys(lines: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """high, low, docs and last (the largest key) of the fewer than ``share`` most frequent line keys.

    Ranges of the hash are counted first, which leaves at most 65,536 numbers;
    only in ranges with too many lines, fewer than ``share``, are keys counted. All of
    it is combined before it is shuffled.
    """
    place = F.shiftrightunsigned("high", 64 - RANGE_BITS)
    counts = lines.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r.place: r.n for r in counts.collect()}  # at most 2^16 rows
    total = sum(counts.values())
    full = [p for p, n in counts.items() if n * share > total]
    some = lines.where(place.isin(full) if full else F.lit(False))
    each = some.groupBy("high", "low", "key").agg(F.count(F.lit(1)).alias("n"))
    found = each.groupBy("high", "low").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"), F.max("key").alias("last"))
    return found.where(F.col("n") * share > total).drop("n")


def dropped_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """key, text_id, n_lines and position of the lines to drop, from a stored table of ``line_hashes``.

    Lines are range-partitioned by hash and sorted by document, the largest
    key first, and position. Walking along, the first document of each hash
    keeps its lines; those of later ones go if enough documents follow
    each other. The window below needs no further exchange or sort.
    Hot keys are judged from counts instead, so no range holds more than one in
    ``HOT_SHARE`` of the lines for the sake of one key.
    """
    hot = stored(hot_keys(lines), "hot-lines")
    few = F.broadcast(hot)  # fewer than HOT_SHARE rows
    same = ["high", "low"]
    names = ["key", "text_id", "n_lines", "position"]
    often = lines.join(few, same).where((F.col("docs") >= min_docs) & ~F.col("key").eqNullSafe(F.col("last")))
    seldom = lines.join(few.select(*same), same, "left_anti")
    order = [F.desc_nulls_last("key"), F.asc("position")]
    seldom = seldom.repartitionByRange(*same).sortWithinPartitions(*same, *order)
    run = Window.partitionBy(*same)
    seldom = seldom.withColumn("nth", F.dense_rank().over(run.orderBy(F.desc_nulls_last("key"))))
    seldom = seldom.withColumn("docs", F.max("nth").over(run))
    return often.select(*names).unionByName(seldom.where((F.col("docs") >= min_docs) & (F.col("nth") > 1)).select(*names))


def keep_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that lose lines, with a compressed bitmap of the lines that stay.

    A text is split at line feeds; a line is compared by what is left after
    stripping white space at both ends and lower-casing A-Z. Lines with at least ``min_chars`` code points
    then, in at least ``min_docs`` documents, stay only in the document with the largest key. A row has key,
    text_id (64 bits of the text), n_lines, n_dropped and keep: the bitmap of kept lines as runs
    (first, lines). Documents without a row keep all lines.

    Rows with equal keys, null ones too, are parts of one document, and null comes after
    all other keys. Null and empty texts have one empty line. Repeated rows share a bitmap. Other columns
    are not read. An empty table gives no rows. Lines are told apart by 128 bits.
    """
    lines = stored(line_hashes(docs, key, text, min_chars), "lines")
    gone = dropped_lines(lines, min_docs)
    rows = gone.groupBy("key", "text_id").agg(
        F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_set("position")).alias("gone")
    )
    # a run of kept lines between each two dropped ones
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.col("n_lines")))
    rows = rows.select("key", "text_id", "n_lines", F.size("gone").alias("n_dropped"), edges.alias("edges"))
    n = F.size("edges") - 1
    runs = F.zip_with(
        F.slice("edges", 1, n), F.slice("edges", 2, n),
        lambda a, b: F.struct((a + 1).alias("first"), (b - a - 1).alias("lines")),
    )
    keep = F.filter(runs, lambda r: r["lines"] > 0)
    return rows.select(F.col("key").alias(key), "text_id", "n_lines", "n_dropped", keep.alias("keep"))


def with_kept_lines(docs: DataFrame, bitmaps: DataFrame, out: str = "kept", key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and n_lines, n_dropped and ``out``, the lines that stay.

    Only documents with a row in ``bitmaps`` change; each text is shuffled once.
    """
    value = F.coalesce(docs[text].cast("string"), F.lit(""))
    rest = [docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text]
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)} | {text: "text"}
    rows = docs.select(docs[key].alias("key"), F.xxhash64(value).alias("text_id"), docs[text].alias("text"), *rest)
    marks = bitmaps.select(
        F.col(key).alias("key"), "text_id", F.col("n_dropped").alias("dropped"), F.col("keep").alias("keep")
    )
    rows = rows.alias("r").join(
        marks.alias("m"), F.col("r.key").eqNullSafe(F.col("m.key")) & (F.col("r.text_id") == F.col("m.text_id")), "left"
    )
    value = F.coalesce(F.col("r.text").cast("string"), F.lit(""))
    left = lambda lines: F.flatten(F.transform("m.keep", lambda r: F.slice(lines, r["first"] + 1, r["lines"])))
    kept = F.transform(F.array(F.split(value, "\n")), lambda lines: F.array_join(left(lines), "\n"))[0]  # split once
    breaks = F.length(value) - F.length(F.replace(value, F.lit("\n"), F.lit("")))
    return rows.select(
        *[F.col(f"r.{name}").alias(c) for c, name in names.items() if c not in ("n_lines", "n_dropped", out)],
        (breaks + 1).cast("long").alias("n_lines"), F.coalesce("m.dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("m.keep").isNull(), value).otherwise(kept).alias(out),
    )
