"""Query functions of the operators: (spark, sf_dir) -> DataFrame over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.alignment import align
from tidemark.llm.bpe import encode_digests
from tidemark.llm.embedding_dedup import near_vectors
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.html_extract import extract
from tidemark.llm.language_id import identify
from tidemark.llm.lexical_search import search
from tidemark.llm.minhash_dedup import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import clean_lines
from tidemark.llm.sharding import shard_rows
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.llm.token_counts import token_counts
from tidemark.sources.tables import read_table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return substring_dedup(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents", ["doc_id", "text"])).drop("ids")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return search(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read_table(spark, sf_dir, "documents", ["doc_id", "text"])).drop("groups")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_substring_dedup, op2_sharding, op3_token_counts, op4_language_id, op5_best_fit_packing, op6_embedding_dedup,
    op7_bpe, op8_minhash_dedup, op9_quality_rules, op10_html_extraction, op11_lexical_search, op12_alignment, op13_exact_dedup)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL: dict[str, str] = {
    "op11_lexical_search": f"""
WITH d AS MATERIALIZED (SELECT doc_id, len(ts) AS n, ts FROM (SELECT doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL) x WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
c AS (SELECT CAST(COUNT(*) AS BIGINT) AS n_docs, CAST(SUM(n) AS BIGINT) AS n_terms FROM d),
p AS MATERIALIZED (SELECT doc_id, n, term, COUNT(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM d) y
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS weight FROM p, c GROUP BY term, n_docs),
s AS (SELECT item_id, doc_id, CAST(SUM(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0) z WHERE place <= 50""",
    "op13_exact_dedup": f"""
SELECT doc_id, MAX(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size, doc_id = MAX(doc_id) OVER same AS kept,
       sha256(folded) AS text_sha256
FROM (SELECT doc_id, translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}') AS folded FROM documents) x
WINDOW same AS (PARTITION BY folded)""",
}
