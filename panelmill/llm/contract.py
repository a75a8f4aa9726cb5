"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.llm.alignment import alignment
from panelmill.llm.arc import convert, read_warc, with_referred_keys, write_arc
from panelmill.llm.lines import keep_bitmaps, with_kept_lines
from panelmill.llm.merkle import manifest
from panelmill.llm.neighbours import search
from panelmill.llm.oracles import ORACLES  # noqa: F401  part of the contract
from panelmill.llm.ordinal import classify
from panelmill.llm.packing import pack
from panelmill.llm.paragraphs import passages_again
from panelmill.llm.pieces import encode_decode
from panelmill.llm.quality import quality_rules
from panelmill.llm.shared import new_folder
from panelmill.llm.simhash import near_duplicates
from panelmill.llm.token_counts import token_counts
from panelmill.llm.token_store import read_store, write_store

PIECE, BYTE, WORD = (
    public_tokenizers.path(name)
    for name in ("piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json")
)

#: Probability of the best grade from which the classifier keeps a document.
KEEP = 0.6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_arc_to_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    arcs = write_arc(pages, new_folder(spark, "arc"))
    warcs = convert(arcs, new_folder(spark, "warc"))
    return with_referred_keys(read_warc(warcs)).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_simhash(spark, sf_dir):
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "fingerprint", "component_id")


def op4_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_counts(docs, "piece", PIECE)


def op5_paragraphs(spark, sf_dir):
    return passages_again(table(spark, sf_dir, "documents"))


def op6_token_store(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    manifest = write_store(docs, new_folder(spark, "token-store"), BYTE)
    return read_store(manifest).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op7_packing(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), WORD)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


def op9_pieces(spark, sf_dir):
    rows = encode_decode(table(spark, sf_dir, "documents"), PIECE)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_ordinal(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), KEEP)


def op11_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = with_kept_lines(docs, keep_bitmaps(docs))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_alignment(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"), BYTE, PIECE)


def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, tampered=F.crc32(docs["doc_id"].cast("string")) % 5 == 0)


QUERIES = {
    f.__name__: f for f in (op1_quality_rules, op2_arc_to_warc, op3_simhash, op4_token_counts, op5_paragraphs, op6_token_store, op7_packing, op8_neighbours, op9_pieces, op10_ordinal,
    op11_line_dedup, op12_alignment, op13_merkle)
}

