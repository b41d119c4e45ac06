"""The corpus pipeline: five stages, each written as Parquet and read again.

Quality rules drop documents, line dedup cuts repeated lines out of the others,
the n-gram Jaccard join keeps one document of each group, mixing repeats and
samples documents to the weights of their sources, and the last stage encodes
what is left.  All stages but the last return the columns of `documents`, with
`n_chars` brought up to date where the text changes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm import bpe, jaccard, lines, mixing, quality
from casegrid.llm.queries import RANKS
from casegrid.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.quality(docs).filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their repeated lines."""
    kept = lines.dedup_lines(docs)
    cut = F.col("n_dropped") > 0
    return kept.withColumns({
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(cut, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.first_of_groups(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mix", source_mix),
    ("byte_bpe", encode),
]

#: Near copies and byte-pair merges are beyond SQL; tests/llm holds the whole run
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
