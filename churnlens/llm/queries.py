"""The registered queries of the operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm import (
    ann_tree,
    chat_format,
    html_extract,
    mixing,
    neardup,
    ngram_lm,
    pii,
    quality_rules,
    secret_scan,
    sp_lattice,
    token_align,
    toxicity,
    whitening,
)
from churnlens.llm.common import table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_schedule(table(spark, sf_dir, "documents"), max_repeats=mixing.MAX_REPEATS)


def op3_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_lattice.encode(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_corpus(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_source_mixing": op2_source_mixing,
    "op3_kmeans_tree": op3_kmeans_tree,
    "op4_toxicity_chain": op4_toxicity_chain,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat_format": op7_chat_format,
    "op8_secret_scan": op8_secret_scan,
    "op9_minhash_neardup": op9_minhash_neardup,
    "op10_ngram_lm": op10_ngram_lm,
    "op11_pii": op11_pii,
    "op12_token_align": op12_token_align,
    "op13_whitening": op13_whitening,
}

_NEAR = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]) END AS shingles
  FROM w
), sizes AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM s
), e AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n, unnest(shingles) AS shingle FROM s
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b
    ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))
), links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
), reach(x, y) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
), least AS (SELECT x, MIN(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least ON x = doc_id
"""

#: op9's contract is a result, whatever finds it: shingles, all pairs that share one, and a recursive closure.
ORACLES: dict[str, str] = {"op9_minhash_neardup": _NEAR}
