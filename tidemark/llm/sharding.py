"""Shards with the corpus' own mixture, by proportional stratified interleaving.

1. Rows are shuffled within their source: ordered by the MD5 of a seed and the
   doc_id, and numbered 1..n by the skew-safe ranker (a source with a third of
   all rows is cut over many partitions).
2. The fractional rank (2 r - 1) / (2 n) spreads every source evenly over (0, 1).
3. All rows are numbered in order of the fractional rank (ties: source, shuffle,
   doc_id) and cut into ``shards`` even runs.  Counts differ by one row at most,
   and each shard holds n / shards rows of a source of n, up to about one.

DataFrame functions only.  Rules: null text has no bytes and the checksum of the empty
string; null sources are one stratum; null doc_ids are shuffled as the string
'null'; rows that repeat are placed each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import group_row_number

SHARDS, SEED = 24, "interleave-1"
ROW_BYTES = 8


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``rows``), source, source_rank."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("shuffle", F.md5(F.concat(F.lit(seed + "/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    ranked = group_row_number(rows, ["source"], ["shuffle", "doc_id", "text_crc32"], "source_rank")
    sizes = rows.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    ranked = ranked.join(sizes, F.col("source").eqNullSafe(F.col("_source"))) \
        .withColumn("fraction", (2 * F.col("source_rank") - 1) / (2 * F.col("n"))).drop("_source", "n")
    placed = group_row_number(ranked, [], ["fraction", "source", "shuffle", "doc_id", "text_crc32"], "place")
    total = F.lit(max(docs.count(), 1))
    place = F.col("place") - 1
    shard = F.expr("(place_ * shards_) div total_")
    placed = placed.withColumns({"place_": place, "shards_": F.lit(shards).cast("long"), "total_": total.cast("long")}) \
        .withColumn("shard", shard.cast("int"))
    first = F.expr("(shard * total_ + shards_ - 1) div shards_")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place_") - first).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "source", "source_rank")
