"""Token ids through a table of distinct chunks.

A text is cut where no token of the vocabulary can cross, each distinct chunk is
encoded once by the tokenizer's own library, and the ids are joined back by
position. The table is two columns, chunks and ids, without an object for each
entry. It lives as long as the Python worker and is bounded: beyond ``most_kept``
entries it goes on with those of the last block, and chunks of more than
``LONGEST_KEPT`` characters are not kept. Chunks that are not in it go to the
library ``TOGETHER`` in one text, for it spends more on a text than on a word;
the lengths of the tokens tell where a chunk ends. Texts for which the cuts are not proven (white space outside
ASCII, control characters that count as white space, special strings, the
marker of the piece model) are encoded whole by the library.

Where the cuts lie:

* ``byte`` (byte-level pieces): before white space that follows other text. The
  splitting pattern matches no run that goes on from other text into white space.
* ``word`` (word ends, white space dropped): at white space.
* ``piece`` (marked pieces): before a space that follows other text, since no
  piece of the model holds the marker after another character, and before a
  line feed, which no piece but its own byte contains. Both are checked when
  the model is loaded.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TABLE_ENTRIES = 400_000
LONGEST_KEPT = 64
#: Texts that the library encodes at a time, and chunks that are put together to a text.
AT_ONCE, TOGETHER = 4096, 256
BLOCK_BYTES = 8 << 20

_ODD_SPACE = (
    r"\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_MARKER = "▁"
_START = "\x02"
_WORD_END = "</w>"
#: Chunks whose tokens are the same wherever they stand in a text of such chunks (``word``: one space apart).
_JOINED = {"byte": r"^[ \n][ \n\t\r]*[^ \n\t\r]+$", "word": "^[!-~]+$"}
_IDS = "<u4"


@contextmanager
def _without_collection() -> Iterator[None]:
    """A block makes a million strings and lists without a cycle: looking for cycles among them only costs time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class ChunkCoder:
    """Ids of whole texts by one vocabulary file, as the library gives them.

    ``kind`` is ``byte``, ``word`` or ``piece``. Special tokens inside texts are
    handled as the library does by default; none are added.
    """

    def __init__(self, kind: str, path: str, most_kept: int = TABLE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.kind, self.most_kept = kind, most_kept
        # the table: chunks, how many ids each has, and all ids one after the other
        self.known, self.counts, self.ids = pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, _IDS)
        specials: list[str] = []
        if kind == "piece":
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
            crossing = re.compile(f"[^{_MARKER}]{_MARKER}|\n")
            if any(crossing.search(p) for p in pieces) or not self._keeps_spaces():
                raise ValueError(f"{path}: pieces can cross the cuts; encode whole texts instead")
            self.vocabulary = len(pieces)
            self.marker_id = self.model.piece_to_id(_MARKER)
        else:
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.vocabulary = self.model.get_vocab_size()
            added = {i: t.content for i, t in self.model.get_added_tokens_decoder().items()}
            specials = list(added.values())
            self.lengths = np.array([  # bytes of text that a token stands for: each of its characters is one
                len(added[i].encode()) if i in added else len((self.model.id_to_token(i) or "").removesuffix(_WORD_END if kind == "word" else ""))
                for i in range(self.vocabulary)
            ], np.int64)
        special = "".join(f"|{re.escape(s)}" for s in specials)
        # the texts that the library has to take whole, and those with runs of white space
        self.whole = {
            "byte": f"[{_ODD_SPACE}\x0b\x0c{_START}]{special}",
            "word": f"[{_ODD_SPACE}\x0b\x0c{_START}]{special}",
            "piece": f"{_MARKER}|{_START}",
        }[kind]
        self.runs = {
            "byte": r"^$|^[ \n]|[ \n]$|[ \n][ \n]|[\t\r]",
            "word": r"[\t\r]",
            "piece": r"^$|^ | $|  | \n|\n ",
        }[kind]
        self.cut = re.compile(
            {
                "byte": r"[ \n\t\r]*[^ \n\t\r]+(?:[ \n\t\r]+\Z)?|[ \n\t\r]+",
                "word": r"[^ \n\t\r]+",
                "piece": r" +[^ \n]*|\n[^ \n]*",
            }[kind]
        )

    def _keeps_spaces(self) -> bool:
        """Whether the model marks each space by itself and puts one marker in front."""
        probe = self.model.encode("a  b ")
        pieces = "".join(self.model.id_to_piece(i) for i in probe)
        return pieces == f"{_MARKER}a{_MARKER * 2}b{_MARKER}"

    # -- the library -------------------------------------------------------

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts by the library alone, one after the other, and how many each text has.

        A few at a time: the library's own objects take much more room than the ids.
        """
        ids, counts = [np.zeros(0, _IDS)], [np.zeros(0, np.int64)]
        for begin in range(0, len(texts), AT_ONCE):
            some = texts[begin : begin + AT_ONCE]
            if self.kind == "piece":
                lists = self.model.encode(some, num_threads=1)
            else:
                lists = [e.ids for e in self.model.encode_batch_fast(some, add_special_tokens=False)]
            counts.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            ids.append(np.fromiter(chain.from_iterable(lists), _IDS, int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def _encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks as they stand inside a text, one after the other, and how many each has."""
        if self.kind == "piece":
            return self._marked(chunks)
        plain = pc.match_substring_regex(chunks, _JOINED[self.kind])
        where = plain.to_numpy(zero_copy_only=False)
        together = self._together(chunks.filter(plain))
        if where.all():
            return together
        return merged(~where, together, self.library(chunks.filter(pc.invert(plain)).to_pylist()))

    def _together(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that may follow one another in a text: many in one, cut again by the lengths of their tokens."""
        if not len(chunks):
            return self.library([])
        begins = pa.array(np.append(np.arange(0, len(chunks), TOGETHER), len(chunks)))
        between = pa.scalar(" " if self.kind == "word" else "", chunks.type)
        texts = pc.binary_join(pa.LargeListArray.from_arrays(begins, chunks), between)
        ids = np.concatenate([self.library([text.as_py()])[0] for text in texts])
        reached = np.cumsum(self.lengths[ids])
        ends = np.cumsum(pc.binary_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64))
        upto = np.searchsorted(reached, ends) + 1
        if upto[-1] != len(ids) or not np.array_equal(reached[upto - 1], ends):  # a token that is not what it spells
            return self.library(chunks.to_pylist())
        return ids, np.diff(upto, prepend=0)

    def _marked(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The library puts a marker in front: it is the chunk's own first space, or falls away."""
        ids, counts = self.library(pc.replace_substring_regex(chunks, "^ ", "").to_pylist())
        begins = np.cumsum(counts) - counts
        away = ~pc.starts_with(chunks, " ").to_numpy(zero_copy_only=False) & (counts > 0)
        counts = counts - away
        ids = ids[_spread(begins + away, counts)]
        lone = np.flatnonzero(pc.equal(chunks, " ").to_numpy(zero_copy_only=False))
        ids = np.insert(ids, (np.cumsum(counts) - counts)[lone], self.marker_id)
        counts[lone] += 1
        return ids, counts

    # -- the table ---------------------------------------------------------

    def values(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct chunks: where each one's ids begin and how many they are, and the ids that this is about."""
        found = pc.index_in(chunks, value_set=self.known)
        new = chunks.filter(found.is_null())
        fresh, n = self._encode(new)
        ids, counts = np.concatenate([self.ids, fresh]), np.concatenate([self.counts, n])
        missing = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[missing] = len(self.known) + np.arange(len(new))
        begins = np.cumsum(counts) - counts
        begin, count = begins[at], counts[at]
        if len(counts) > self.most_kept:  # go on with what this block has used
            short = pc.less_equal(pc.utf8_length(chunks), LONGEST_KEPT)
            kept = short.to_numpy(zero_copy_only=False)
            self.known, self.counts = chunks.filter(short), count[kept]
            self.ids = ids[_spread(begin[kept], count[kept])]
        elif len(new):
            short = pc.less_equal(pc.utf8_length(new), LONGEST_KEPT)
            kept = short.to_numpy(zero_copy_only=False)
            self.known = pa.concat_arrays([self.known, new.filter(short)])
            self.counts = np.concatenate([self.counts, n[kept]])
            self.ids = np.concatenate([self.ids, fresh if kept.all() else fresh[_spread((np.cumsum(n) - n)[kept], n[kept])]])
        return begin, count, ids

    # -- texts -------------------------------------------------------------

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text begins (and the end).

        A null is an empty text.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        ids, counts, begin = [], [], 0
        for end in [*(np.flatnonzero(np.diff(np.cumsum(size) // BLOCK_BYTES)) + 1), len(texts)]:
            if end > begin:
                with _without_collection():
                    some, n = self._block(texts.slice(begin, end - begin))
                ids.append(some)
                counts.append(n)
            begin = end
        lengths = np.concatenate([np.zeros(1, np.int64), *counts])
        return np.concatenate(ids) if ids else np.zeros(0, _IDS), np.cumsum(lengths)

    def _block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        runs = pc.match_substring_regex(texts, self.runs).to_numpy(zero_copy_only=False) & ~whole
        plain = ~whole & ~runs
        per_text = np.zeros(len(texts), np.int64)
        chunks, at = pa.array([], pa.large_string()), np.zeros(0, np.int64)  # text by text, the chunks' numbers
        if plain.any():
            cut = texts.filter(pa.array(plain))
            if self.kind == "byte":
                start, nothing = (pa.scalar(x, cut.type) for x in (_START, ""))
                cut = pc.binary_join_element_wise(start, cut, nothing)
            cut = pc.split_pattern(pc.replace_substring(cut, "\n", " " if self.kind == "word" else " \n"), " ")
            per_text[plain] = pc.list_value_length(cut).to_numpy(zero_copy_only=False)
            coded = cut.flatten().dictionary_encode()
            chunks, at = self._as_chunks(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        rest: list[str] = []
        for i in np.flatnonzero(runs):
            text = texts[int(i)].as_py()
            found = self.cut.findall(" " + text if self.kind == "piece" and text else text)
            per_text[i] = len(found)
            rest += found
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(runs)])
        at = np.concatenate([at, len(chunks) + np.arange(len(rest))])
        coded = pa.concat_arrays([chunks, pa.array(rest, pa.large_string())]).dictionary_encode()
        begins, length, flat = self.values(coded.dictionary)
        chunk = coded.indices.to_numpy(zero_copy_only=False)[at]
        n = length[chunk]
        ids = flat[_spread(begins[chunk], n)]
        ends = np.cumsum(n)
        upto = np.concatenate([np.zeros(1, np.int64), ends])[np.cumsum(per_text[order])]
        counts = np.zeros(len(texts), np.int64)
        counts[order] = np.diff(upto, prepend=0)
        if runs.any() or whole.any():  # back into the order of the texts
            alone, counts[whole] = self.library([texts[int(i)].as_py() for i in np.flatnonzero(whole)])
            source = np.zeros(len(texts), np.int64)
            source[order] = upto - counts[order]
            source[whole] = len(ids) + np.cumsum(counts[whole]) - counts[whole]
            ids = np.concatenate([ids, alone])
            ids = ids[_spread(source, counts)]
        return ids, counts

    def _as_chunks(self, pieces: pa.Array) -> pa.Array:
        """What was cut off at spaces gets its space back, unless a line feed stands there or the text begins."""
        if self.kind == "word":
            return pc.if_else(pc.string_is_ascii(pieces), pc.ascii_lower(pieces), pieces)
        return pc.replace_substring(pc.replace_substring(spaced(pieces), " \n", "\n"), f" {_START}", "")


def spaced(texts: pa.Array) -> pa.Array:
    """A space before each text."""
    return pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type))


def merged(where: np.ndarray, one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids and each text's count from those of the texts not ``where`` and those of the texts there."""
    counts, source = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
    for at, n, base in ((~where, one[1], 0), (where, other[1], len(one[0]))):
        counts[at], source[at] = n, np.cumsum(n) - n + base
    return np.concatenate([one[0], other[0]])[_spread(source, counts)], counts


def _spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions begin, begin + 1, … of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 30 and (not len(begins) or begins.max() < 1 << 30) else np.int64
    at = np.repeat((begins - (ends - lengths)).astype(kind), lengths)
    at += np.arange(total, dtype=kind)
    return at


_CODERS: dict[tuple[str, str], ChunkCoder] = {}


def coder(kind: str, path: str) -> ChunkCoder:
    """The worker's coder for a vocabulary, loaded once."""
    if (kind, path) not in _CODERS:
        _CODERS[kind, path] = ChunkCoder(kind, path)
    return _CODERS[kind, path]


def per_text(texts: pa.Array, code: ChunkCoder, use: Callable[[np.ndarray], object]) -> list:
    """``use`` of each text's ids."""
    ids, begins = code.encode(texts)
    return [use(ids[b:e]) for b, e in zip(begins[:-1], begins[1:], strict=True)]
