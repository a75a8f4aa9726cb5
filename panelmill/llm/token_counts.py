"""Token counts through a cache of digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.durable import file_exists
from panelmill.llm.batches import slices
from panelmill.llm.chunks import coder
from panelmill.llm.shared import map_batches, new_folder, stored
from panelmill.llm.skew import look_up

CACHE = "content_digest binary, tokenizer_digest binary, n_tokens bigint"
LIBRARY = {"piece": "sentencepiece", "byte": "tokenizers", "word": "tokenizers"}


def tokenizer_digest(kind: str, path: str) -> bytes:
    """SHA-256 over the vocabulary file, and the name and version of the library."""
    name = LIBRARY[kind]
    with open(path, "rb") as file:
        return hashlib.sha256(f"{name} {version(name)}\n".encode() + file.read()).digest()


def normalised(text: Column) -> Column:
    """What is digested and counted: the text itself, a null as empty text.

    Anything more (case, white space, Unicode form) would change the counts.
    """
    return F.coalesce(text.cast("string"), F.lit(""))


def token_counts(
    docs: DataFrame, kind: str, path: str, cache: str | None = None, limit: int = 4096,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: key, n_bytes, n_tokens and whether these are more than ``limit``.

    ``cache`` is a Parquet folder of (content digest, tokenizer digest, count); it
    need not exist yet, and without one the cache lasts as long as the session.
    Distinct contents that the cache does not know for this tokenizer are encoded
    once, in tasks, and appended by one write, which commits as a whole: a run
    that dies before leaves the cache as it was, and a digest that two runs add
    at once is only stored twice. The counts are then joined to the rows by
    digest; frequent contents are looked up without a shuffle (see ``skew``).

    Null texts count as empty (0 bytes, 0 tokens). Repeated rows and null or
    repeated keys each give their own row. Other columns are not read. An empty
    table gives no rows and leaves the cache as it is.
    """
    spark = docs.sparkSession
    cache = cache or f"{new_folder(spark, 'token-cache')}/rows"
    tokenizer = F.lit(tokenizer_digest(kind, path))
    content = docs.select(docs[key].alias("key"), normalised(docs[text]).alias("text"))
    content = content.withColumn("content_digest", F.unhex(F.sha2("text", 256)))
    rows = stored(content.select("key", F.octet_length("text").cast("long").alias("n_bytes"), "content_digest"), "digests")

    def known() -> DataFrame:
        if not file_exists(spark, f"{cache}/_SUCCESS"):
            return spark.createDataFrame([], CACHE)
        return spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer_digest") == tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(kind, path)
        for part in slices(batches, "text"):
            _, begins = code.encode(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("content_digest"), pa.array(np.diff(begins))],
                names=["content_digest", "n_tokens"],
            )

    misses = content.groupBy("content_digest").agg(F.first("text").alias("text"))
    misses = misses.join(known().select("content_digest"), "content_digest", "left_anti")
    counted = map_batches(misses, count, "content_digest binary, n_tokens bigint")
    counted.select("content_digest", tokenizer.alias("tokenizer_digest"), "n_tokens").write.mode("append").parquet(cache)
    counts = known().groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    return look_up(rows, counts, "content_digest").select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
