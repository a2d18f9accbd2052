"""The stages of the corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.

1. quality_rules: failed lines leave the text, rejected documents go.
2. language_id: documents without a sure language go; the classifier is fitted on
   the stage's own input.  Where that holds nothing to learn from (no labelled
   document, or only held-out ones), documents with a letter stay.
3. minhash_dedup: one document of each class of near copies stays, the one with
   the smallest doc_id (rows that repeat a doc_id: the least row).
4. substring_dedup: passages that a document with a smaller id holds leave the
   text; documents with nothing left go.
5. best_fit_packing: the pieces with their token ids and their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.language_id import annotate, learn
from tidemark.llm.minhash_dedup import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import clean_lines
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.llm.tables import written
from tidemark.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_SCORE = 0.5


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # as a generated column the verdict is computed once; a plain filter would repeat it below the projection
    verdict = F.explode(F.array(F.struct("kept", "clean_text"))).alias("verdict")
    judged = clean_lines(docs.select(*COLUMNS)).select(*COLUMNS, verdict)
    return _documents(judged.where("verdict.kept").withColumn("text", F.col("verdict.clean_text")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learn(docs)
    if not model.weights.any():      # nothing learned, or a single language
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    sure = (F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)
    return annotate(docs, model).where(sure).select(*COLUMNS)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = written(near_duplicates(docs).where("kept").select("doc_id"), "kept")
    ids = kept.where("doc_id is not null").distinct()
    stay = docs.join(ids, "doc_id", "left_semi").select(*COLUMNS)
    if kept.where("doc_id is not null").count() > ids.count():      # rows that repeat a doc_id
        stay = stay.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*")
    return stay.unionByName(docs.where("doc_id is null").select(*COLUMNS))


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup(docs)
    return _documents(cut.where("n_words = 0 or n_removed < n_words").withColumn("text", F.col("kept_text")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("minhash_dedup", minhash_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("best_fit_packing", best_fit_packing),
]

# SQL can express neither the classifier, the signatures nor the tokenizer; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", list(COLUMNS))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
