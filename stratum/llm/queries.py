"""Registered queries of the pipeline operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import decontaminate, hamming_topk, html_text, huffman, license_scan, merkle, near_dedup, packing, prefix_trie, repeats, secret_scan, sharding, toxicity
from stratum.llm.oracle import ORACLE_SQL
from stratum.llm.ship import ship

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> str:
    """The tokenizer file of the token queries; operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), 16)


def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), short_inside=True)


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, bits = hamming_topk.sign_codes(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return hamming_topk.top_k(codes, codes.filter(F.col("id") % 50 == 0), bits, k=10)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(read(spark, sf_dir, "documents")).drop("spans")


def op7_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.base_digest(secret_scan.scan_versions(docs, ["doc_id"]))


def op8_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(read(spark, sf_dir, "documents"), size=4, percent=80)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op9_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = huffman.coded_documents(read(spark, sf_dir, "documents"), tokenizer())
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_block_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op12_time_forward_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(read(spark, sf_dir, "documents"))


def op13_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_jump_shards, op2_nnls_packing, op3_minhash_containment, op4_multi_index_hashing, op5_toxicity, op6_bucket_refinement, op7_blob_ledger, op8_super_minhash, op9_tree_scoring, op10_huffman_ids,
    op11_block_trie, op12_time_forward_manifest, op13_diagonal_voting)}
