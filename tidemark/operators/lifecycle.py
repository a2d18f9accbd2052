"""Lifecycle stage, revival and spike flags, cross-market statistics.

The reference computes the per-(item, week) market statistics with two
GROUP BYs joined back to the history.  Because the weekly grain is unique and
its keys are never null, the same numbers come from one window partitioned by
(item, week): ``count(country)`` equals ``COUNT(DISTINCT country)`` and the
sum / count of non-null growth gives the average.  That removes two
aggregates and two joins (and their exchanges) from the plan; every window
partition holds at most one row per market.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import (catalog_revival_flag, growth_as_decimal, lifecycle_stage,
                                        market_spike_flag)
from tidemark.operators.weekly import GROWTH_COLUMNS
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds

LIFE_COLUMNS = (
    "spotify_id", "track_name", "artists", "country", "chart_week",
    "weekly_chart_points", "previous_week_chart_points", "wow_chart_points_change", "wow_growth_rate",
    "avg_daily_rank", "best_daily_rank", "chart_days", "avg_popularity",
    "album_name", "album_release_date",
    "avg_danceability", "avg_energy", "avg_valence", "avg_acousticness",
    "avg_speechiness", "avg_instrumentalness", "avg_liveness", "avg_tempo",
    "cross_market_count", "selected_market_avg_wow_growth",
    "lifecycle_stage", "catalog_revival_flag", "market_spike_flag")

#: What campaigns look up in other markets.
RATE_COLUMNS = ("spotify_id", "country", "chart_week", "wow_growth_rate")


def with_history(growth: DataFrame) -> DataFrame:
    """``win_first_week``, ``win_max_points``, ``win_prev_week`` on (item, market)."""
    whole = Window.partitionBy("spotify_id", "country")
    ordered = whole.orderBy("chart_week")
    out = growth
    if "previous_chart_week" not in growth.columns:
        out = out.withColumn("previous_chart_week", F.lag("chart_week").over(ordered))
    return (out
            .withColumn("first_chart_week", F.min("chart_week").over(whole))
            .withColumn("max_weekly_chart_points", F.max("weekly_chart_points").over(whole)))


def with_market_stats(growth: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``cross_market_penetration`` + ``market_average_growth`` as one window on (item, week)."""
    w = Window.partitionBy("spotify_id", "chart_week")
    return (growth
            .withColumn("_growth_dec", growth_as_decimal("wow_growth_rate", t))
            .withColumn("cross_market_count", F.count("country").over(w))
            .withColumn("_market_growth_sum", F.sum("_growth_dec").over(w))
            .withColumn("_market_growth_n", F.count("wow_growth_rate").over(w))
            .withColumn("selected_market_avg_wow_growth",
                        F.when(F.col("_market_growth_n") > 0,
                               F.col("_market_growth_sum").cast("double") / F.col("_market_growth_n"))))


def classify(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``lifecycle_stage``, ``catalog_revival_flag``, ``market_spike_flag``."""
    gap = F.datediff(F.col("chart_week"), F.col("previous_chart_week"))
    return (df.withColumn("gap_days", gap)
              .withColumn("lifecycle_stage", lifecycle_stage(t=t))
              .withColumn("catalog_revival_flag", catalog_revival_flag(t=t))
              .withColumn("market_spike_flag", market_spike_flag(t=t)))


def lifecycle(growth: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS, columns: Sequence[str] = LIFE_COLUMNS) -> DataFrame:
    """``model_lifecycle``: the 28 columns, or those named."""
    return classify(with_market_stats(with_history(growth), t), t).select(*columns)


def penetration_join_form(growth: DataFrame) -> DataFrame:
    """``cross_market_penetration`` as the reference writes it: GROUP BY (item, week)."""
    return growth.groupBy("spotify_id", "chart_week").agg(F.countDistinct("country").alias("cross_market_count"))


__all__ = ["LIFE_COLUMNS", "GROWTH_COLUMNS", "lifecycle", "with_history", "with_market_stats", "classify",
           "penetration_join_form"]
