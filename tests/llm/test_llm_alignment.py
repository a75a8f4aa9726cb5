"""Tokenizer alignment against both libraries and plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from panelmill.llm import alignment
from panelmill.llm.contract import BYTE, PIECE, QUERIES

SCHEMA = "doc_id bigint, text string, links string, key string, pair string, n string"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def expected(libraries, rows):
    a, b = libraries
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown}
    letters |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def b_bytes(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def of(text):
        if not text:
            return None
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        tokens = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], [b_bytes(i) for i in ids[1]]
        if any(b"".join(t) != (" " + text).encode() for t in tokens):
            return None
        ends = []
        for t in tokens:
            at = 0
            ends.append({(at := at + len(x)): i for i, x in enumerate(t)})
        links, groups, begin = [], [], (0, 0)
        for end in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0][end], ends[1][end]
            links.append((ids[0][i], ids[1][j]))
            groups.append(",".join(map(str, ids[0][begin[0]:i + 1])) + "|" + ",".join(map(str, ids[1][begin[1]:j + 1])))
            begin = (i + 1, j + 1)
        return len(ids[0]), len(ids[1]), links, ";".join(groups)

    found = [of(text) for _, text in rows]
    count = Counter(p for f in found if f for p in f[2])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for (key, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = f
        out.append((
            key, n_a, n_b, groups.count(";") + 1, len(links), sum(count[p] == best[p[1]] for p in links),
            sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def odd_texts(n):
    draw = random.Random(5)
    parts = ["word", "Word", "naïve", "日本語", " ", "  ", "\n", "\t", "\r\n", "!", "...", "'s", "123", "<|endoftext|>", "<s>", "</s>", "　",
             "\x00", "🙂", "é", "é", "<0x41>", "ſ", "\x0b", "\xa0", "xx", "a" * 40]
    return ["".join(draw.choices(parts, k=draw.randint(1, 12))) for _ in range(n)]


def test_odd_texts(spark, libraries):
    rows = [(i, t) for i, t in enumerate(odd_texts(600))]
    rows += [(None, "a null key"), (None, None), (2000, None), (2001, ""), (2002, " "), (2003, "has the ▁ marker"), (2004, "same"), (2004, "same"),
             (2004, "same"), (2005, "long text " * 30_000), (2006, " leading"), (2007, "\nline"), (2008, "x")]
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(4)
    assert sorted(map(tuple, alignment.alignment(docs, BYTE, PIECE).collect()), key=str) == expected(libraries, rows)


def test_registered_query(spark, small, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_alignment"](spark, small).collect()), key=str) == expected(libraries, rows)


def test_empty(spark):
    assert alignment.alignment(spark.createDataFrame([], SCHEMA), BYTE, PIECE).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, alignment.alignment(docs, BYTE, PIECE).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_bound_of_the_pairs():
    a, b = [b"x", b"ab", b"b"], [b"b", b"cab", b"x"]
    linked = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x.endswith(y) or y.endswith(x)}
    assert alignment.most_pairs(a, b) == len(linked)
    most = alignment.most_pairs(alignment.byte_tokens(BYTE), alignment.piece_tokens(PIECE))
    assert most < 1_000_000
