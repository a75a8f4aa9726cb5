"""Repeated runs of words and the removal of passages, against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from panelmill.llm import paragraphs, runs
from panelmill.llm.contract import QUERIES

SCHEMA = "doc_id bigint, text string, row_id string, place string, band string, key string, row string"


def words_of(text):
    return (text or "").encode().lower().split()


def shingle_hash(words):
    """The polynomial over word hashes, one word after the other."""
    out = 0
    for w in words:
        out = (out * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(w)) & (2**64 - 1)
    out = ((out ^ out >> 31) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    return out ^ out >> 29


def covered(rows, size=40, span=11):
    """key to [(first word, words)] that occurred before, from (key, text) in the order of keys."""
    first, places = {}, []
    for key, text in rows:
        words = words_of(text)
        hashes = [shingle_hash(words[i:i + size]) for i in range(len(words) - size + 1)]
        least = sorted({min(range(s, s + span), key=lambda i: (hashes[i], i)) for s in range(len(hashes) - span + 1)})
        for i in least:
            again = first.setdefault(hashes[i], (key, i)) != (key, i)
            if again:
                places.append((key, i))
    out = {}
    for key, i in places:
        own = out.setdefault(key, [])
        if own and i <= own[-1][0] + own[-1][1]:
            own[-1] = (own[-1][0], i + size - own[-1][0])
        else:
            own.append((i, size))
    return out


def prose(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(n)]


def shared_windows(texts, n=50):
    """Pairs of documents that hold the same ``n`` words."""
    seen, pairs = {}, set()
    for key, text in texts:
        words = words_of(text)
        for i in range(len(words) - n + 1):
            other = seen.setdefault(tuple(words[i:i + n]), key)
            if other != key:
                pairs.add((other, key))
    return pairs


def test_hashes_of_runs_of_words():
    words = [w.encode() for w in prose(1, 120)]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    for size in (1, 2, 3, 40, 50, 64):
        assert runs.shingle_hashes(hashes, size).tolist() == [shingle_hash(words[i:i + size]) for i in range(120 - size + 1)]
    assert len(runs.shingle_hashes(hashes[:39], 40)) == 0 and len(runs.shingle_hashes(hashes[:0], 40)) == 0


PASSAGE = prose(7, 55)


@pytest.fixture(scope="module")
def texts():
    in_line = [" ".join(prose(i, 60) + PASSAGE + prose(100 + i, 40)) for i in range(3)]
    over_lines = ["\n".join(" ".join((prose(200 + i, 9) + PASSAGE + prose(300 + i, 13))[j:j + 11]) for j in range(0, 77, 11)) for i in range(3)]
    upper = " ".join(prose(400, 5)) + "\t" + "  ".join(PASSAGE).upper() + " " + " ".join(prose(401, 5))
    short = " ".join(PASSAGE[:39])
    return [
        *enumerate(in_line + over_lines + [upper]), (20, short), (21, short), (22, None), (23, ""), (24, " \n "),
        (25, " ".join(PASSAGE)), (26, " ".join(PASSAGE)), (27, "x " * 400), (28, "é " * 60), (29, "é " * 60),
        (30, " ".join(prose(500, 30) + PASSAGE + prose(501, 20) + PASSAGE)), (31, " ".join(prose(9, 5000) + PASSAGE)),
    ]


@pytest.mark.parametrize("stored", [False, True])
def test_runs(spark, tmp_path, texts, stored):
    """From files and from a table that is no file, with clashing columns."""
    docs = spark.createDataFrame([(*t, *["x"] * 5) for t in texts], SCHEMA).repartition(3)
    if stored:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    got = runs.repeated_runs(runs.numbered(docs, "doc_id", "text")).collect()
    found = {}
    for r in got:
        found.setdefault(r.key, []).append((r.begin, r.n_words))
    assert {k: sorted(v) for k, v in found.items()} == covered(texts)
    assert {1, 2, 3, 4, 5, 6, 26, 29, 30, 31} <= set(found) and not {0, 20, 21} & set(found)
    cut = paragraphs.without_repeats(docs)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert not shared_windows(sorted((k, t) for k, t in left.items()))
    assert 26 not in left and 29 not in left and left[22] is None and left[23] == ""
    assert words_of(left[1]) == [w.encode() for w in prose(1, 60) + prose(101, 40)] or len(words_of(left[1])) <= 115
    assert left[0] == dict(texts)[0] and left[20] == left[21] == dict(texts)[20]


def test_repeated_rows_and_null_keys(spark):
    text = " ".join(PASSAGE)
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (None, text)], "doc_id bigint, text string").repartition(3)
    assert [tuple(r) for r in paragraphs.without_repeats(docs).collect()] == [(3, text)]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert paragraphs.without_repeats(empty).collect() == [] and paragraphs.passages_again(empty).collect() == []


def test_cut_out():
    assert paragraphs.cut_out("a b c d e", [], [(1, 2)]) == "a \n d e"
    assert paragraphs.cut_out("a b\nc d\ne f", [1], [(4, 1)]) == "a b\n f"
    assert paragraphs.cut_out("ä ö\nü", [0], [(0, 1)]) == "ü"
    assert paragraphs.cut_out("a b", [0], []) == ""


def test_registered_query(spark, small):
    """Lines against exact Jaccard over all pairs, runs against plain Python."""
    from test_llm_queries import _groups

    rows = sorted(tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op5_paragraphs"](spark, small).collect()
    found = [(k, n, len(w), paragraphs.shingles(w, 5)) for k, t in rows for n, w in paragraphs.passages(t, 50)]
    groups = _groups(len(found), lambda i, j: len(found[i][3] & found[j][3]) >= 0.8 * len(found[i][3] | found[j][3]))
    members = {}
    for i, g in enumerate(groups):
        members.setdefault(g, []).append(i)
    want = {
        (*found[i][:3], *found[g][:2], len(m), i != g) for g, m in members.items() if len(m) > 1 for i in m
    }
    lines = {(r.doc_id, r.place, r.n_words, r.first_doc_id, r.first_place, r.cluster_size, r.removed) for r in got if r.kind == "line"}
    assert lines == want
    runs_found = {}
    for r in got:
        if r.kind == "run":
            assert r.removed and (r.first_doc_id, r.first_place) < (r.doc_id, r.place)
            runs_found.setdefault(r.doc_id, []).append((r.place, r.n_words))
    assert {k: sorted(v) for k, v in runs_found.items()} == covered(rows)
