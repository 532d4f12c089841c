"""From raw documents to a training mix: identify, deduplicate, decontaminate, redact, mix.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's docs. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinmart.llm import decontam, lang_id, near_text, pii, source_mix
from skeinmart.llm.tables import read
from skeinmart.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that language identification rejects."""
    return lang_id.keep_identified(docs.select(*COLUMNS))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id.

    SimHash of five-word shingles, with pivot tables, finds pairs that are verified by their Jaccard similarity
    of 0.8 or more; an exact search adds the links that SimHash misses.
    """
    return near_text.deduplicate(docs.select(*COLUMNS))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontam.remove_leaks(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind. n_chars stays the length of the source text."""
    return pii.redact(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in random order, with copy_no and shuffle_key."""
    return source_mix.mix(docs.select(*COLUMNS))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
]

# Language models, SimHash and edit distances are beyond SQL; the tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each one's result is written before the next begins."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
