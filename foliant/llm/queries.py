"""The queries of this subpackage: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import canon, chunks, encoding, mixing, quality, scans, tokens, truncation
from foliant.session import table


def p1_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.page_kinds(table(spark, sf_dir, "raw_pages"), table(spark, sf_dir, "common_words"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_stats(spark, sf_dir).where("kind <> 'prose'").select("page_id", "kind")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.garbled_lines(table(spark, sf_dir, "raw_pages")).select(F.col("id").alias("page_id")).distinct()


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.repaired(table(spark, sf_dir, "raw_pages"))


def p2_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and pages by chain of encodings."""
    return encoding.garbled_lines(table(spark, sf_dir, "raw_pages")).groupBy("chain").agg(F.count("*").alias("n_lines"), F.countDistinct("id").alias("n_pages"))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.pieces(table(spark, sf_dir, "extracted_docs"), table(spark, sf_dir, "chunk_limits"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts of which the operator makes more than one piece."""
    return p3_pieces(spark, sf_dir).where("piece_no = 2").select("extract_id")


def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.canonical_texts(table(spark, sf_dir, "raw_pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.lookalike_pairs(table(spark, sf_dir, "raw_pages"))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.lookalike_classes(table(spark, sf_dir, "raw_pages"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.noise(table(spark, sf_dir, "raw_pages"))


def p5_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.clean_pages(table(spark, sf_dir, "raw_pages"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_ids(table(spark, sf_dir, "documents"))


def p6_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts rebuilt from their ids, beside their number; the SQL gives the texts as they are stored."""
    docs = table(spark, sf_dir, "documents")
    return tokens.token_text(tokens.token_ids(docs)).select("doc_id", "text")


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached, beside the targets."""
    return mixing.shares(p7_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p7_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of sources, languages and topics, beside those they are to have."""
    return mixing.margins(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "documents")).where("truncated").select(F.col("id").alias("doc_id"))


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(truncation.truncated(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_stats": p1_stats,
    "p2_found": p2_found,
    "p2_repaired": p2_repaired,
    "p2_chains": p2_chains,
    "p3_found": p3_found,
    "p3_pieces": p3_pieces,
    "p4_found": p4_found,
    "p4_canonical": p4_canonical,
    "p4_classes": p4_classes,
    "p5_found": p5_found,
    "p5_clean": p5_clean,
    "p6_ids": p6_ids,
    "p6_roundtrip": p6_roundtrip,
    "p7_mixture": p7_mixture,
    "p7_shares": p7_shares,
    "p7_margins": p7_margins,
    "p8_found": p8_found,
    "p8_rates": p8_rates,
}

SQL: dict[str, str] = {
    "p3_found": """
        SELECT e.extract_id FROM extracted_docs e
        LEFT JOIN chunk_limits l USING (chunking_strategy)
        CROSS JOIN (SELECT max_chars FROM chunk_limits WHERE chunking_strategy = 'fallback') f
        WHERE length(e.extracted_text) > coalesce(l.max_chars, f.max_chars)
    """,
    "p6_roundtrip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
