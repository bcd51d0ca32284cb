"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm import (
    conversations,
    embed_dedup,
    graph_search,
    merkle,
    minhash,
    nbest,
    packing,
    pii,
    quality_ftrl,
    quality_rules,
    secret_scan,
    toxicity,
    warc_zstd,
)
from termweave.llm.common import table
from termweave.llm.native_spans import written
from termweave.llm.oracle import ARCHIVE_SQL, MERKLE_SQL, SHINGLE_SQL, VECTOR_SQL


def _count(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secret_scan.secrets(table(spark, sf_dir, "documents"))
    return got.select("doc_id", *[_count("base", k) for k in secret_scan.KINDS[:3]],
                      F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                      written(F.col("spans")).alias("spans"), _count("spans", "random"))


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.private_spans(table(spark, sf_dir, "documents"))
    return got.select("doc_id", *[_count("base", k) for k in pii.BASE],
                      F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                      written(F.col("spans")).alias("spans"),
                      (F.size("spans") - F.size("base")).cast("long").alias("n_more"))


def op3_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    got = nbest.encode_nbest(table(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"))
    return got.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                      "score", "scores", "changes", "round_trip")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ftrl.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def pack_documents(docs: DataFrame, **params) -> DataFrame:
    """Packing with the public byte-level vocabulary."""
    import public_tokenizers as public

    return packing.pack(docs, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"),
                        public.PATTERN, **params)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "reason", "ratio", "n_chunks", "n_low_chunks", "n_high_chunks")


def op9_minhash_inverted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.round_trip(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = merkle.verified(table(spark, sf_dir, "documents"))
    digests = [merkle.hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")]
    return got.select("doc_id", *digests, F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "verified")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(table(spark, sf_dir, "conversations"))


def op13_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_pii_weak_supervision": op2_pii_weak_supervision,
    "op3_sentencepiece_nbest": op3_sentencepiece_nbest,
    "op4_toxicity": op4_toxicity,
    "op5_quality_ftrl": op5_quality_ftrl,
    "op6_subspace_join": op6_subspace_join,
    "op7_packing": op7_packing,
    "op8_compression_bands": op8_compression_bands,
    "op9_minhash_inverted_join": op9_minhash_inverted_join,
    "op10_warc_zstd": op10_warc_zstd,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_graph_search": op13_graph_search,
}

ORACLE: dict[str, str] = {
    "op6_subspace_join": VECTOR_SQL,
    "op9_minhash_inverted_join": SHINGLE_SQL,
    "op10_warc_zstd": ARCHIVE_SQL,
    "op11_merkle_manifest": MERKLE_SQL,
}
