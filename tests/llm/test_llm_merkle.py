"""Merkle manifest against plain Python, for several shapes of trees."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from panelmill.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp string, position string, key string, n string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes, fan):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i:i + fan]) for i in range(0, len(found[-1]), fan)])
    return found


def path(found, at, fan):
    out = []
    for nodes in found[:-1]:
        begin = at // fan * fan
        out.append((nodes[begin:at], nodes[at + 1:begin + fan]))
        at //= fan
    return out


def expected(rows, fan):
    lower = lambda t: t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = levels_of([leaf(r) for r in groups[name]], fan)
    over = levels_of([trees[n][-1][0] for n in names], fan) if names else []
    for place, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            steps = path(trees[name], at, fan) + path(over, place, fan)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf((*row[:4], lower(row[4]))) if changed else leaf(row)
            for before, after in steps:
                node = h(*before, node, *after)
            siblings = h(*[d for before, after in steps for d in before + after])
            root = over[-1][0]
            out.append((row[0], leaf(row), trees[name][-1][0], root, siblings, node, node == root))
    return sorted(out, key=str)


def got(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(5)
    tampered = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    return sorted(map(tuple, merkle.manifest(docs, tampered=tampered, **options).collect()), key=str)


ODD = [
    (1, None, None, None, None), (None, None, "en", 3, "ABC"), (None, "a", "en", 3, "ABC"), (None, "a", "en", 3, "ABC"),
    (7, "a", "en", 1, "same key"), (7, "a", "en", 1, "Same Key"), (7, "a", "en", 1, "Same Key"),
    (8, "", "", 0, ""), (9, "-", "-", 0, "-"), (10, "é", "fr", 1, "Élan ÉCOLE"), (11, "z" * 50, "en", 90_000, "Long " * 18_000),
    (12, "Z", "en", 1, "UPPER"), (-3, "Z", "en", 1, "lower"),
]


@pytest.mark.parametrize("fan,levels,n", [(16, 3, 300), (2, 2, 70), (3, 1, 100), (2, 3, 1)])
def test_trees(spark, fan, levels, n):
    """One source with most rows, many with one, and rows of every odd kind."""
    rows = [(i * 7 % 1009, "big", "en", i, f"Text {i}") for i in range(n)] + [(i, f"s{i}", None, i, "x") for i in range(n // 4)]
    rows += ODD
    assert got(spark, rows, fan=fan, levels=levels) == expected(rows, fan)


def test_one_row_and_none(spark):
    rows = [(5, "a", "en", 1, "only")]
    assert got(spark, rows) == expected(rows, 16)
    assert got(spark, []) == []


def test_only_few_levels_are_stored(spark):
    leaves = spark.range(70).select(
        F.lit("a").alias("grp"), F.col("id").alias("position"), F.lit(70).cast("bigint").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    sizes = [level.count() for level in merkle.build(leaves, fan=2, levels=3)]
    assert sizes == [70, 9, 2, 1] or sizes == [70, 9, 2], sizes


def test_positions_spread_a_large_group(spark):
    rows = spark.range(5000).select(F.lit("a").alias("grp"), (F.col("id") * 7919 % 5003).alias("key"))
    placed = merkle.with_positions(rows, ["grp"], ["key"]).collect()
    assert [r.position for r in sorted(placed, key=lambda r: r.key)] == list(range(5000))
    assert {r.n for r in placed} == {5000}
