"""Quality rules with thresholds learned per language and source from quantile sketches.

Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.shared import stored
from panelmill.llm.skew import look_up

SPACE = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

#: Sketched figures, each a whole number, the percentile of its group that a rule starts from and how many
#: spreads a document may lie above it, where a spread is the distance from the 50th to that percentile. Figures
#: that are mostly zero in clean text start from the 99th.
RULES: Mapping[str, tuple[str, int, int]] = {
    "symbols_permille": ("n_symbols * 1000 div n_words", 90, 4),
    "duplicates_permille": ("n_dup_lines * 1000 div n_words", 99, 1),
    "repeats_permille": ("n_repeat_words * 1000 div n_words", 99, 1),
    "chars_percent": ("word_chars * 100 div n_words", 90, 4),
}
#: What is added to a limit: the width of the sketch's smallest bucket.
RESOLUTION = 1
#: A group with fewer documents is judged by its language's sketch, a rare language by all documents'.
MIN_GROUP = 100
#: Values below 2^7 have buckets of their own; above, a bucket spans 1/64 of its value.
SKETCH_BITS = 7


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.transform(F.array(value), use)[0]


def _joined(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` after it."""
    n = F.size(hashes) - step
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))


def _covered(starts: Column) -> Column:
    """Words in the windows that begin at these places (ascending, at least one)."""
    n = F.size(starts) - 1
    gaps = F.zip_with(F.slice(starts, 1, n), F.slice(starts, 2, n), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)


def repeat_words(words: Column) -> Column:
    """Words that lie in 8-word windows found twice or more in the text, the first one included.

    Windows are compared by 64-bit hashes, put together from hashes of 2 and 4 words.
    Only a text with equal hashes sorts them to find their places.
    """

    def places(hashes: Column) -> Column:
        at = F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(0), F.size(hashes) - 1).alias("i"))
        pairs = lambda s: F.zip_with(
            F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
            lambda a, b: F.when(a["0"] == b["0"], F.array(a["1"], b["1"])),
        )
        named = F.transform(at, lambda x: F.struct(x["h"].alias("0"), x["i"].alias("1")))
        return _let(F.sort_array(named), lambda s: F.array_sort(F.array_distinct(F.flatten(F.array_compact(pairs(s))))))

    count = lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), _let(places(h), _covered)
    ).otherwise(F.lit(0))
    single = F.transform(words, lambda w: F.xxhash64(w))
    by_two = _let(single, lambda h: _joined(h, 1))
    by_four = _let(by_two, lambda h: _joined(h, 2))
    by_eight = _let(by_four, lambda h: _joined(h, 4))
    return F.when(F.size(words) > WINDOW, _let(by_eight, count)).otherwise(F.lit(0))


def measured(docs: DataFrame, key: str, text: str, lang: str, source: str, rows: bool = False) -> DataFrame:
    """key, grp, n_words and the base figures per row; with ``rows``, the row's own columns as a struct."""
    named = lambda c: F.coalesce(F.concat(F.lit("="), docs[c].cast("string")), F.lit("-"))
    kept = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if rows else []
    base = docs.select(
        docs[key].alias("key"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
        named(lang).alias("lang"), F.concat(named(lang), F.lit("\n"), named(source)).alias("grp"), *kept,
    )
    kept = ["row"] if rows else []
    base = base.withColumn("words", F.array_remove(F.split("text", SPACE + "+"), ""))
    base = base.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(NO_SPACE)))
    return base.select(
        "key", "lang", "grp", *kept,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def sketch(rows: DataFrame, by: list[str]) -> DataFrame:
    """Quantile sketches of the figures: by, figure, bucket, n.

    A sketch is a histogram over buckets whose width follows the value, so two
    sketches merge by adding the counts of equal buckets. It has at most 64
    buckets for each doubling of the value, however many rows it has seen.
    """
    figures = F.array(*[F.struct(F.lit(name).alias("figure"), F.expr(value).alias("v")) for name, (value, _, _) in RULES.items()])
    long = rows.where(~F.col("base_failed")).select(*by, F.inline(figures))
    shift = F.greatest(F.length(F.bin("v")) - SKETCH_BITS, F.lit(0))
    long = long.withColumn("shift", shift)
    bucket = F.col("shift") * (1 << SKETCH_BITS) + F.expr("shiftright(v, shift)")
    return long.groupBy(*by, "figure", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*by, "figure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: list[str], percents: tuple[int, ...] = (50, 90, 99)) -> DataFrame:
    """by, figure, documents and p50, p90, p99: the upper end of the bucket where a quantile lies."""
    whole = [*by, "figure"]
    group = Window.partitionBy(*whole)  # a row for each bucket of a sketch
    seen = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    steps = sketches.select(*whole, "bucket", seen.alias("seen"), F.sum("n").over(group).alias("documents"))
    reached = [
        F.min(F.when(F.col("seen") * 100 >= F.col("documents") * p, F.col("bucket"))).alias(f"b{p}") for p in percents
    ]
    got = steps.groupBy(*whole, "documents").agg(*reached)
    size = 1 << SKETCH_BITS
    upper = [F.expr(f"shiftleft(b{p} % {size} + 1, cast(b{p} div {size} as int)) - 1").alias(f"p{p}") for p in percents]
    return got.select(*whole, "documents", *upper)


def thresholds(rows: DataFrame) -> DataFrame:
    """grp and the most that each figure may be there: a row for each group of language and source."""
    own = stored(sketch(rows, ["lang", "grp"]), "sketches")
    levels = [
        quantiles(own, ["lang", "grp"]),
        quantiles(merged(own, ["lang"]), ["lang"]),
        quantiles(merged(own, []), []),
    ]
    groups = rows.select("lang", "grp").distinct()
    figures = F.explode(F.array(*map(F.lit, RULES))).alias("figure")
    found = groups.select("lang", "grp", figures)
    for i, (level, by) in enumerate(zip(levels, (["lang", "grp"], ["lang"], []), strict=True)):
        level = level.select(*by, "figure", F.struct("documents", "p50", "p90", "p99").alias(f"level{i}"))
        found = found.join(level, [*by, "figure"], "left")
    big = lambda c: F.when(F.col(c)["documents"] >= MIN_GROUP, F.col(c))
    found = found.withColumn("q", F.coalesce(big("level0"), big("level1"), F.col("level2")))
    most = F.lit(None).cast("long")
    for name, (_, percent, spreads) in RULES.items():
        high, middle = F.col("q")[f"p{percent}"], F.col("q")["p50"]
        bound = high + spreads * (high - middle) + RESOLUTION
        most = F.when(F.col("figure") == name, bound).otherwise(most)
    return found.groupBy("grp").agg(
        *[F.max(F.when(F.col("figure") == name, most)).alias(f"most_{name}") for name in RULES]
    )


def _verdict() -> Column:
    """False for a row that fails a base rule or lies above a threshold of its group."""
    inside = [~F.coalesce(F.expr(value) > F.col(f"most_{name}"), F.lit(False)) for name, (value, _, _) in RULES.items()]
    ok = inside[0]
    for one in inside[1:]:
        ok = ok & one
    return F.when(F.col("base_failed"), F.lit(False)).otherwise(ok)


def quality_rules(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Per row: key, n_words, the base figures, base_failed and kept.

    Base rules are fixed: at least 20 words, and at most 30 percent of them in
    repeated 8-word windows. The other rules have no fixed cut: for each language
    and source, mergeable sketches over all documents that pass the base rules
    give the 50th, 90th and 99th percentile of four figures (symbols, duplicate lines and
    repeated words for each word, mean word length), and a document is rejected
    if one of its figures lies further above a high percentile than ``RULES`` allows, measured
    by the group's own spread. Sketches are merged up to the language, or to all documents, for groups of fewer than 100.

    A null text has no words and fails. Null languages and sources are groups of
    their own. Repeated rows and repeated or null keys each get their row and
    count each time. Other columns are not read. An empty table gives no rows.
    The figures are computed once and kept as a narrow table in the shared
    folder; sketches are aggregated before they are shuffled, and thresholds of
    frequent groups are joined without a shuffle.
    """
    rows = stored(measured(docs, key, text, lang, source), "figures")
    judged = look_up(rows, thresholds(rows), "grp")
    return judged.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", _verdict().alias("kept"),
    )


def keep_good(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """The rows, with all their columns, that ``quality_rules`` keeps."""
    rows = stored(measured(docs, key, text, lang, source, rows=True), "figures")
    judged = look_up(rows, thresholds(rows), "grp").where(_verdict())
    return judged.select(*[F.col("row")[c].alias(c) for c in docs.columns])
