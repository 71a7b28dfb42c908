"""The registered queries of this subpackage and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import debruijn, embed_dedup, filter_audit, html_labels, html_text, language_id, line_dedup, minhash, oracles, packing, piece_lattice, quality, sharding, suffix_dedup, turn_repair


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(_table(spark, sf_dir, "embeddings"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = html_text.fit(spark, html_labels.labelled())
    return html_text.extract(_table(spark, sf_dir, "pages"), tree).select("page_id", "url", "text", "n_chars")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def tokenizer_file(name: str) -> str:
    """Where the vocabulary files of public tokenizers are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def _cut(kept: DataFrame) -> DataFrame:
    """Digest of texts after words were removed: the words joined by single spaces."""
    words = F.regexp_replace(F.btrim("text", F.lit(quality.SPACE)), quality.SPACES, " ")
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(suffix_dedup.dedup_passages(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the hash of what they decode to."""
    model = tokenizer_file("piece_bpe_32k.model")
    encoded = piece_lattice.encode(_table(spark, sf_dir, "documents"), model)
    decoded = piece_lattice.decode(encoded, model)
    text = F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", text)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "d2")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", F.crc32(text.cast("binary")).alias("text_crc32"), sharding.text_size(F.col("text")).alias("bytes")
    )
    placed = sharding.shard_by_bytes(rows, "doc_id", F.col("bytes"), 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(debruijn.dedup_passages(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.train(docs))
    held_out = F.coalesce(language_id.quarter(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return turn_repair.with_all(conversations, turn_repair.repair(turn_repair.damage(conversations)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    known = [op1_embedding_dedup, op2_html_extraction, op3_line_dedup, op4_packing, op5_suffix_array_dedup, op6_sentencepiece, op7_quality_rules, op8_sharding, op9_minhash_dedup, op10_substring_dedup, op11_filter_audit, op12_language_id, op13_turn_repair]
    return {query.__name__: query for query in known}


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
