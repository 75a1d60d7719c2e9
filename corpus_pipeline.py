"""From raw documents to token ids: five stages, each one operator applied to all that the stage before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a frame; the caller stores it and
reads it back as the next stage's ``docs``. All but the last return the columns of
``docs``. Null texts, repeated rows, empty tables and extra columns are treated as the
operators define them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import bpe, mixing, ngram_join, quality_rules, repeated_bytes
from tierline.llm.common import read_table, stored


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row, of the document with the smallest id."""
    return ngram_join.keep_one(docs)


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur elsewhere; ``n_chars``, where there is one, follows the text."""
    out = repeated_bytes.strip(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate asks for."""
    return mixing.emit(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every taken copy, and the hash of what the ids decode to."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), decoded=True)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256)
    return coded.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", decoded.alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", filter_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", strip_repeats),
    ("mix_to_weights", mix_sources),
    ("bpe", encode_tokens),
]

#: Similarity joins, suffix sorting and encoding have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
