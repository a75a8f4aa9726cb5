"""The coder's table of chunks: ids as the library gives them for whole texts, whatever was coded before. Links of two coders in blocks."""

from __future__ import annotations

import random
from collections import Counter
from types import SimpleNamespace
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from panelmill.llm import alignment, chunks
from panelmill.llm.contract import BYTE, PIECE, WORD

PARTS = [
    "the", "THE", "a", "é", "İ", "ſ", "´", "1", "'s", "'", "</w>", "</", "w>", "<|endoftext|>", " ", "  ", "\n", "\n\n",
    "\t", "\r", "\x0b", "\x1c", "\xa0", "　", "▁", "\x02", "\x00", ",", "!?", "#", "漢", "🙂", "<0x0A>", "<s>", "x" * 70,
]


def _texts(seed: int) -> list[str | None]:
    draw = random.Random(seed)
    odd = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 20))) for _ in range(300)]
    even = [" ".join("".join(draw.choice(PARTS[:14]) for _ in range(3)) for _ in range(20)) for _ in range(100)]
    return [None, "", " ", "\n", *odd, *even]


@pytest.mark.parametrize("kind, path", [("byte", BYTE), ("word", WORD), ("piece", PIECE)])
@pytest.mark.parametrize("most_kept", [10, 500, chunks.TABLE_ENTRIES])
def test_ids_are_those_of_whole_texts(kind, path, most_kept):
    code = chunks.ChunkCoder(kind, path, most_kept)
    for texts in (_texts(1), _texts(2), _texts(1), []):
        ids, begins = code.encode(pa.array(texts, pa.string()))
        want, counts = code.library([t or "" for t in texts])
        assert np.diff(begins).tolist() == counts.tolist() and np.array_equal(ids, want)
        assert len(code.known) == len(code.counts) and code.counts.sum() == len(code.ids)
    assert "x" * 70 not in " ".join(code.known.to_pylist())


@pytest.mark.parametrize("kind, path", [("byte", BYTE), ("word", WORD)])
def test_words_go_to_the_library_many_in_a_text(kind, path, monkeypatch):
    code, seen = chunks.ChunkCoder(kind, path), []
    whole = code.library
    monkeypatch.setattr(code, "library", lambda texts: (seen.extend(texts), whole(texts))[1])
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}," for i in range(3000)]
    texts = pa.array([" ".join(words), " ".join(words[::-1])])
    ids, begins = code.encode(texts)
    assert len(seen) <= 3000 / chunks.TOGETHER + 10
    want, counts = whole(texts.to_pylist())
    assert np.array_equal(ids, want) and np.diff(begins).tolist() == counts.tolist()
    seen.clear()
    assert np.array_equal(code.encode(texts)[0], want) and not seen


def test_tokens_that_are_not_what_they_spell_are_encoded_one_by_one():
    code = chunks.ChunkCoder("byte", BYTE)
    code.lengths = code.lengths + 1
    texts = ["one two, three", "four five"]
    ids, begins = code.encode(pa.array(texts))
    want, counts = code.library(texts)
    assert np.array_equal(ids, want) and np.diff(begins).tolist() == counts.tolist()


class _Caught(Exception):
    """Carries the function that would run in the tasks."""


def _in_task(monkeypatch, call):
    def catch(df, run, schema):
        raise _Caught(run)

    monkeypatch.setattr(alignment, "map_batches", catch)
    with pytest.raises(_Caught) as caught:
        call()
    return caught.value.args[0]


def _links(seen: list[int], monkeypatch) -> tuple[pa.RecordBatch, list[list[int]]]:
    """A batch of many links, and a watch on how many are taken out of it at a time."""
    flatten = pc.list_flatten
    monkeypatch.setattr(alignment.pc, "list_flatten", lambda x: (seen.append(len(flat := flatten(x))), flat)[1])
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 64, raising=False)
    draw = random.Random(3)
    links = [[draw.randrange(40) for _ in range(draw.randrange(12))] for _ in range(500)]
    zeros = pa.array([0] * 500, pa.int64())
    names = ["key", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
    columns = [pa.array(range(500)), zeros, zeros, zeros, pa.array([""] * 500), pa.array(links, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=names), links


def test_pairs_are_counted_a_block_at_a_time(monkeypatch):
    run, seen = _in_task(monkeypatch, lambda: alignment.pair_counts(MagicMock(), 10)), []
    batch, links = _links(seen, monkeypatch)
    got = {r["pair"]: r["n"] for b in run(iter([batch, batch])) for r in b.to_pylist()}
    assert got == {p: 2 * n for p, n in Counter(p for x in links for p in x).items()}
    assert max(seen) <= 64 + 12


def test_counts_are_looked_up_a_block_at_a_time(monkeypatch):
    known = pa.table({"pair": list(range(39, -1, -1)), "n": [p * 7 for p in range(39, -1, -1)], "best": [p % 3 == 0 for p in range(39, -1, -1)]})
    docs, pairs = MagicMock(), MagicMock()
    docs.sparkSession.sparkContext.broadcast = lambda table: SimpleNamespace(value=table)
    pairs.toArrow.return_value = known
    for name, made in (("aligned", MagicMock()), ("stored", MagicMock()), ("pair_counts", lambda *_: pairs), ("byte_tokens", lambda _: []), ("piece_tokens", lambda _: []), ("most_pairs", lambda *_: 40)):
        monkeypatch.setattr(alignment, name, made)
    run, seen = _in_task(monkeypatch, lambda: alignment.alignment(docs, "a", "b")), []
    batch, links = _links(seen, monkeypatch)
    got = [r for b in run(iter([batch, batch.slice(0, 0), batch])) for r in b.to_pylist()]
    assert [(r["key"], r["n_links"], r["n_best"], r["count_sum"]) for r in got] == 2 * [
        (i, len(x), sum(p % 3 == 0 for p in x), sum(7 * p for p in x)) for i, x in enumerate(links)
    ]
    assert max(seen) <= 64 + 12
