"""Encoding and decoding with a piece model, through a table of distinct marked words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from panelmill.llm.batches import lists, slices
from panelmill.llm.chunks import coder
from panelmill.llm.shared import map_batches


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``ids`` (array of int, no begin or end) and ``decoded``, the text of the ids.

    The pieces of the model never cross a space that follows other text, so each
    distinct marked word is segmented once per worker (see ``chunks``), its ids
    are joined back by position, and the library decodes the ids of the whole
    text. The table is kept per worker and bounded, because a table over all
    workers would need a shuffle of every (partition, word) pair, which costs
    more than segmenting the words again.

    A null text counts as empty and gives no ids and an empty decoded text.
    Repeated rows and repeated or null keys each give their own row; the other
    columns are not read, so their names cannot clash. An empty table gives no
    rows. The work is one pass without a shuffle, in blocks of about 8 MB of
    text or one longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder("piece", model)
        for part in slices(batches, "text"):
            ids, begins = code.encode(part.column("text"))
            decoded = [code.model.decode(ids[b:e].tolist()) for b, e in zip(begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), lists(ids, begins), pa.array(decoded, pa.string())],
                names=["key", "ids", "decoded"],
            )

    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = map_batches(rows, run, f"key {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("key", key)
