"""Corpus pipeline: quality rules, near-dedup, secret redaction, source mixing, piece encoding.

``STAGES`` lists (name, function) in order; a function takes (spark, docs,
sf_dir) and returns a DataFrame.  Each stage works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
``run`` writes each stage below the shared checkpoint folder and reads it back
as the next one's input, so a lost executor repeats one stage's tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm import mixing, neardup, quality_rules, secret_scan, sp_lattice
from churnlens.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return neardup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, findings masked in their texts."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources repeated towards the target weights."""
    return mixing.mix_documents(docs, max_repeats=mixing.MAX_REPEATS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, round_trip and piece ids of every document."""
    return sp_lattice.encode(docs)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", dedup),
    ("secret scans", secrets),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

#: No stage can be said in SQL alone: rules are learned, links confirmed on hashed trees, pieces found by Viterbi.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
