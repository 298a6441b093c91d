"""Registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

import zlib

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, language, lexical, licences, ngram_join, packing, sharding, simhash, spelling, spotsigs, substring, topk, warc
from daybook.llm.check_sql import ORACLES as ORACLES
from daybook.llm.tables import read_table, written

CAPACITY, END_ID = 2048, 1


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return packed_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))


def packed_pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Pieces with a checksum of their ids, placed in sequences."""

    def digested(batch: pa.RecordBatch) -> pa.RecordBatch:
        bounds, flat = batch.column(3).offsets.to_numpy().tolist(), batch.column(3).values.to_numpy().astype("<u4").data
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(bounds, bounds[1:])]
        return batch.set_column(3, "ids_crc32", pa.array(sums, pa.int64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    view = (digested, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")
    rows = written(packing.pieces_of(docs, vocabulary, END_ID, CAPACITY, view=view), "pieces")
    return packing.pack(rows, CAPACITY).withColumnRenamed("id", "doc_id")


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read_table(spark, folder, "documents")
    view = bpe.digest_view(docs.schema["doc_id"].dataType.simpleString(), ranks, pattern)
    return bpe.encoded(docs, ranks, pattern, view=view).withColumnRenamed("id", "doc_id")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    back = warc.round_trip(read_table(spark, folder, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(read_table(spark, folder, "documents"))


def op5_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.against_next(read_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    profiles = language.learn(docs.where(fold != 2))
    found = language.with_language(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_products(read_table(spark, folder, "embeddings"), F.col("id") % 20 == 0, 20)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substring.without_repeats(read_table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.sharded(read_table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = lexical.top_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), 10)
    return rows.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read_table(spark, folder, "documents"))


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = ngram_join.linked(read_table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_byte_bpe, op3_warc, op4_license_scan, op5_spotsigs, op6_language_id, op7_topk, op8_substring_dedup,
        op9_sharding, op10_simhash, op11_lexical_search, op12_spelling_variants, op13_ngram_join, pipeline,
    )
}
