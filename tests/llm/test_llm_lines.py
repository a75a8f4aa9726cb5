"""Line dedup against plain Python, with hot keys, repeated rows, nulls and clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from panelmill.llm import lines

SCHEMA = (
    "doc_id bigint, text string, key string, keep string, lines string, text_id string, n_lines string, "
    "n_dropped string, high string, row string"
)
LONG = "this line is long enough to count"


def expected(rows, min_chars=20, min_docs=3):
    """(key, text) to (n_lines, n_dropped, kept text)."""
    strip = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x).strip(" \t\n\x0b\f\r")
    holders = {}
    for key, text in rows:
        for line in (text or "").split("\n"):
            if len(strip(line)) >= min_chars:
                holders.setdefault(strip(line), set()).add(key)
    order = lambda k: (k is not None, k or 0)
    last = {x: max(ks, key=order) for x, ks in holders.items() if len(ks) >= min_docs}
    out = []
    for key, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if last.get(strip(x), key) == key]
        out.append((key, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(spark, rows, **options):
    docs = spark.createDataFrame([(*r, *["x"] * 8) for r in rows], SCHEMA).repartition(3)
    out = lines.with_kept_lines(docs, lines.keep_bitmaps(docs, **options))
    assert set(docs.columns) <= set(out.columns)
    return sorted(map(tuple, out.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


def test_cases(spark):
    rows = [
        (1, LONG), (2, f"  {LONG.upper()}\t\r\nother\n{LONG}"), (3, f"a\n{LONG}\n\nb\n{LONG}\n"),
        (3, f"second part\n{LONG}"),  # same key: same document
        (4, "only two documents hold this line"), (5, "only two documents hold this line"),
        (6, "x" * 19), (7, "x" * 19), (8, "x" * 19), (9, "é" * 20), (10, "é" * 20), (11, "é" * 20), (12, "É" * 20),
        (None, f"{LONG}\nunder a null key"), (None, None), (13, None), (14, ""), (15, "\n\n"),
        (16, "the same row again and again"), (16, "the same row again and again"), (16, "the same row again and again"),
        (17, " " + "y" * 20), (18, "y" * 20), (19, "y" * 20 + " "),
        (-5, "\n".join(f"line {i} of a very long text, said once" for i in range(5000)) + f"\n{LONG}"),
    ]
    assert got(spark, rows) == expected(rows)


@pytest.mark.parametrize("share", [4096, 3])
def test_hot_keys(spark, monkeypatch, share):
    """One line in a third of all documents, others twice or often, whichever way they are judged."""
    monkeypatch.setattr(lines, "HOT_SHARE", share)
    monkeypatch.setattr(lines.hot_keys, "__defaults__", (share,))
    draw = random.Random(share)
    pool = [f"a line of the pool with number {i}" for i in range(40)]
    rows = [(draw.randrange(150), "\n".join(draw.choices(pool, k=draw.randrange(6)) + [LONG] * (i % 3 == 0))) for i in range(300)]
    assert got(spark, rows) == expected(rows)
    assert got(spark, rows, min_docs=5, min_chars=30) == expected(rows, 30, 5)


def test_hot_keys_are_found(spark):
    rows = [(i, f"{LONG}\nthe line number {i} is its own") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    hot = lines.hot_keys(lines.line_hashes(docs, "doc_id", "text", 20), share=10).collect()
    assert [(r.docs, r["last"]) for r in hot] == [(300, 299)]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lines.with_kept_lines(docs, lines.keep_bitmaps(docs)).collect() == []


def test_bitmap_is_runs(spark):
    text = "\n".join(["a", LONG, LONG, "b", "c", LONG])
    docs = spark.createDataFrame([(1, text), (2, LONG), (3, LONG)], "doc_id bigint, text string")
    row = lines.keep_bitmaps(docs).where("doc_id = 1").first()
    assert (row.n_lines, row.n_dropped, [tuple(r) for r in row["keep"]]) == (6, 3, [(0, 1), (3, 2)])


def test_ranges_are_walked_without_another_exchange(spark):
    rows = spark.range(100).select(
        F.col("id").alias("key"), F.col("id").alias("text_id"), F.lit(1).alias("n_lines"), F.lit(0).alias("position"),
        F.xxhash64("id").alias("high"), F.col("id").alias("low"),
    )
    plan = lines.dropped_lines(rows, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(high") == 1
    walk = plan[:plan.index("rangepartitioning(high")]
    assert walk.count("hashpartitioning") == 0 and walk.count("Sort [") == 1, walk
