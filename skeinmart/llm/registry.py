"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontam, hmm_lm, lang_id, pii, prefix_trie, quality, quotes, simhash, source_mix, suffix_dedup, token_store, vector_dedup, whitening,
)
from .tables import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_texts(read(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(read(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_id.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", *lang_id.ADDED)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(read(spark, sf_dir, "conversations"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).drop("k_id", "k_text")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text``: what is left of a text; U+FFFD stands for the rest of a character that was cut."""
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(read(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read(spark, sf_dir, "documents"))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "edits")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """``vocabulary``: file of the tokenizer, by default the installed public byte-level BPE."""
    return token_store.store_and_digest(read(spark, sf_dir, "documents"), vocabulary or public_tokenizer())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


OPERATORS = [
    op1_hmm_scores, op2_source_mix, op3_language, op4_quality, op5_quote_links, op6_simhash, op7_suffix_dedup, op8_near_vectors,
    op9_personal_data, op10_benchmark_leaks, op11_whitening, op12_token_files, op13_prefix_trie,
]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in OPERATORS}


def statements() -> dict[str, str]:
    return {
        "op2_source_mix": source_mix.MIX_SQL.format(docs="documents"), "op5_quote_links": quotes.QUOTES_SQL,
        "op8_near_vectors": VECTORS_SQL, "op13_prefix_trie": prefix_trie.TRIE_SQL,
    }


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT e.vec_id, (SELECT COUNT(*) FROM link WHERE a = e.vec_id) AS n_links,
  LEAST(e.vec_id, COALESCE((SELECT MIN(b) FROM reach WHERE a = e.vec_id), e.vec_id)) AS component_id,
  e.vec_id <= COALESCE((SELECT MIN(b) FROM reach WHERE a = e.vec_id), e.vec_id) AS kept
FROM embeddings e
"""
