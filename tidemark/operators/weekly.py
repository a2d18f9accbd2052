"""Weekly rollup and week-over-week growth (grain: item x market x week)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import chart_points, growth_rate, week_of
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds

FEATURES = ("danceability", "energy", "valence", "acousticness",
            "speechiness", "instrumentalness", "liveness", "tempo")

WEEKLY_COLUMNS = (
    "spotify_id", "track_name", "artists", "country", "chart_week",
    "weekly_chart_points", "avg_daily_chart_points", "avg_daily_rank", "best_daily_rank",
    "chart_days", "avg_popularity", "first_chart_date_in_week", "last_chart_date_in_week",
    "album_name", "album_release_date") + tuple(f"avg_{f}" for f in FEATURES)

GROWTH_COLUMNS = (
    "spotify_id", "track_name", "artists", "country", "chart_week",
    "weekly_chart_points", "avg_daily_chart_points", "avg_daily_rank", "best_daily_rank",
    "chart_days", "avg_popularity", "album_name", "album_release_date") \
    + tuple(f"avg_{f}" for f in FEATURES) \
    + ("previous_week_chart_points", "wow_chart_points_change", "wow_growth_rate")


def with_chart_points(charts: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``chart_points``: 201 - daily_rank per chart row."""
    return charts.withColumn("chart_points", chart_points("daily_rank", t))


#: What a growth rate is made of: chart, weekly and growth columns.
RATE_CHART_COLUMNS = ("spotify_id", "country", "snapshot_date", "daily_rank")
RATE_WEEKLY_COLUMNS = ("spotify_id", "country", "chart_week", "weekly_chart_points")
RATE_COLUMNS = RATE_WEEKLY_COLUMNS + ("previous_week_chart_points", "wow_chart_points_change", "wow_growth_rate")


def weekly_aggregates(charts: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS, columns: Sequence[str] = WEEKLY_COLUMNS) -> DataFrame:
    """``weekly_aggregates``: one row per (item, market, Monday week).

    The rows are shuffled once on (item, market): that clustering satisfies
    this aggregate AND every later (item, market) window (LAG, first week,
    best week), so the chain has one exchange instead of two, and the sort
    that groups the weeks is the sort the windows need.  A partition holds
    one row per charted day of an item in a market — bounded by the length
    of the calendar, not by the data volume.  Chart columns that none of
    ``columns`` is made of need not be there.
    """
    pts = chart_points("daily_rank", t)
    aggregates = {
        "track_name": F.max("track_name"),
        "artists": F.max("artists"),
        "weekly_chart_points": F.sum(pts).cast("long"),
        "avg_daily_chart_points": F.avg(pts),
        "avg_daily_rank": F.avg("daily_rank"),
        "best_daily_rank": F.min("daily_rank"),
        "chart_days": F.count(F.lit(1)),
        "avg_popularity": F.avg("popularity"),
        "first_chart_date_in_week": F.min("snapshot_date"),
        "last_chart_date_in_week": F.max("snapshot_date"),
        "album_name": F.max("album_name"),
        "album_release_date": F.min("album_release_date"),
        **{f"avg_{f}": F.avg(f) for f in FEATURES}}
    return (charts
            .repartition("spotify_id", "country")
            .groupBy("spotify_id", "country", week_of("snapshot_date").alias("chart_week"))
            .agg(*[a.alias(c) for c, a in aggregates.items() if c in columns])
            .select(*columns))


def item_market_window():
    return Window.partitionBy("spotify_id", "country").orderBy("chart_week")


def with_previous_week(weekly: DataFrame) -> DataFrame:
    """``win_prev_points`` + ``win_prev_week``: LAG over the previous *charted* week.

    One Window node: a partition holds one item in one market, so its size is
    bounded by the number of weeks, never by the data volume.
    """
    w = item_market_window()
    return (weekly
            .withColumn("previous_week_chart_points", F.lag("weekly_chart_points").over(w))
            .withColumn("previous_chart_week", F.lag("chart_week").over(w)))


def weekly_growth(weekly: DataFrame, keep_history: bool = False, carry: Sequence[str] = (),
                  columns: Sequence[str] = GROWTH_COLUMNS) -> DataFrame:
    """``model_weekly_growth``: weekly columns (less the in-week dates) + change + rate."""
    g = (with_previous_week(weekly)
         .withColumn("wow_chart_points_change", F.col("weekly_chart_points") - F.col("previous_week_chart_points"))
         .withColumn("wow_growth_rate", growth_rate("weekly_chart_points", "previous_week_chart_points")))
    cols = [*columns, *(["previous_chart_week"] if keep_history else []), *carry]
    return g.select(*cols)
