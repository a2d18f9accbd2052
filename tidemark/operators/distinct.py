"""Exact distinct counts under any selection, from bitmaps of dense item codes.

COUNT(DISTINCT item) does not add up over market-weeks, so every filter of the dashboard
would scan the mart again.  Here each item has a dense code (its rank among all items), and every
market-week holds, per 32,768 codes, one bitmap of the items charted there, of those in several
markets and of those in many.  Bitmaps are merged with OR: the distinct items of any selection of
market-weeks are the bits of the merged bitmaps.  A selection reads the bitmap table only, at most
one row per market-week and 32,768 items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import group_row_number
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds

#: Bitmaps by condition on the mart's rows.
SETS = ("total_tracks", "multi_market_tracks", "cross_market_champions")


def item_codes(life: DataFrame) -> DataFrame:
    """spotify_id, code: gapless from 1 in the order of the ids; no code for null."""
    items = life.select("spotify_id").where(F.col("spotify_id").isNotNull()).distinct()
    return group_row_number(items, [], ["spotify_id"], "code")


def item_bitmaps(life: DataFrame, codes: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """country, chart_week, bucket and a bitmap per set of ``SETS``."""
    rows = life.select("spotify_id", "country", "chart_week", "cross_market_count").join(codes, "spotify_id")
    bit = "bitmap_construct_agg(bitmap_bit_position(code))"
    return rows.groupBy("country", "chart_week", F.expr("bitmap_bucket_number(code)").alias("bucket")).agg(
        F.expr(bit).alias("total_tracks"),
        F.expr(f"{bit} FILTER (WHERE cross_market_count >= {t.multi_market_min})").alias("multi_market_tracks"),
        F.expr(f"{bit} FILTER (WHERE cross_market_count >= {t.champion_min})").alias("cross_market_champions"))


def distinct_items(bitmaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct items of the selected market-weeks, in each set of ``SETS``, per value of ``by``."""
    merged = bitmaps.groupBy(*by, "bucket").agg(*[F.expr(f"bitmap_or_agg({s})").alias(s) for s in SETS])
    return merged.groupBy(*by).agg(*[F.coalesce(F.sum(F.expr(f"bitmap_count({s})")), F.lit(0)).cast("long").alias(s) for s in SETS])
