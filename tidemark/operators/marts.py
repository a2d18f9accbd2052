"""The four output marts: repertoire, market trends, campaigns, KPI catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import release_age_days, repertoire_signal
from tidemark.operators.lifecycle import LIFE_COLUMNS
from tidemark.operators.ranking import group_row_number, top1_per_group
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds

REP_COLUMNS = (
    "spotify_id", "track_name", "artists", "country", "chart_week",
    "weekly_chart_points", "previous_week_chart_points", "wow_chart_points_change", "wow_growth_rate",
    "avg_daily_rank", "best_daily_rank", "chart_days", "avg_popularity",
    "album_name", "album_release_date", "release_age_days",
    "avg_danceability", "avg_energy", "avg_valence", "avg_acousticness",
    "avg_speechiness", "avg_instrumentalness", "avg_liveness", "avg_tempo",
    "cross_market_count", "lifecycle_stage", "catalog_revival_flag", "market_spike_flag",
    "market_week_rank", "repertoire_signal")

SUMMARY_COLUMNS = (
    "country", "chart_week", "tracks_tracked", "total_chart_points", "avg_wow_growth_rate",
    "debut_tracks", "growing_tracks", "peak_tracks", "declining_tracks", "revived_tracks",
    "market_spike_count", "catalog_revival_count", "multi_market_tracks", "cross_market_champions",
    "avg_market_popularity", "avg_danceability", "avg_energy", "avg_valence", "avg_acousticness")

TOP_COLUMNS = ("top_spotify_id", "top_track_name", "top_artists", "top_track_chart_points")
MKT_COLUMNS = SUMMARY_COLUMNS + TOP_COLUMNS


def with_market_rank(life: DataFrame, name: str = "market_week_rank") -> DataFrame:
    """``win_market_rank``: ROW_NUMBER by points desc within (market, week), ties by item.

    The wide rows themselves go through the skew-safe ranker, which writes them
    once: nothing is joined back on data keys, so rows with null keys stay.
    """
    return group_row_number(life, ["country", "chart_week"], [("weekly_chart_points", False), ("spotify_id", True)], name)


def repertoire(life: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``mart_repertoire``: 30 columns."""
    base = life.select(*[c for c in LIFE_COLUMNS if c != "selected_market_avg_wow_growth"]) \
        .withColumn("release_age_days", release_age_days()) \
        .withColumn("repertoire_signal", repertoire_signal(t=t))
    return with_market_rank(base).select(*REP_COLUMNS)


def _summary(t: Thresholds) -> list[Column]:
    """The measures of a market-week.

    The grain (item, market, week) is unique, so COUNT(DISTINCT item) per market-week is a plain
    count of ids; a row without an id counts in no COUNT(DISTINCT item).
    """
    stage = F.col("lifecycle_stage")
    spread = lambda n: F.count_if((F.col("cross_market_count") >= n) & F.col("spotify_id").isNotNull())
    return [F.count("spotify_id").alias("tracks_tracked"),
            F.sum("weekly_chart_points").cast("long").alias("total_chart_points"),
            F.avg("wow_growth_rate").alias("avg_wow_growth_rate"),
            *[F.count_if(stage == s.title()).alias(f"{s}_tracks") for s in ("debut", "growing", "peak", "declining", "revived")],
            F.count_if(F.col("market_spike_flag")).alias("market_spike_count"),
            F.count_if(F.col("catalog_revival_flag")).alias("catalog_revival_count"),
            spread(t.multi_market_min).alias("multi_market_tracks"),
            spread(t.champion_min).alias("cross_market_champions"),
            F.avg("avg_popularity").alias("avg_market_popularity"),
            *[F.avg(f"avg_{f}").alias(f"avg_{f}") for f in ("danceability", "energy", "valence", "acousticness")]]


def country_week_summary(life: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``country_week_summary`` incl. ``multi_market_tracks`` / ``cross_market_champions``: one partial + final aggregate."""
    return life.groupBy("country", "chart_week").agg(*_summary(t)).select(*SUMMARY_COLUMNS)


def top_track(life: DataFrame) -> DataFrame:
    """``win_top_track``: best item per (market, week) by points, ties by item."""
    t = top1_per_group(life, ["country", "chart_week"], "weekly_chart_points", "spotify_id",
                       ["spotify_id", "track_name", "artists", "weekly_chart_points"])
    return t.select("country", "chart_week",
                    F.col("top_spotify_id"), F.col("top_track_name"), F.col("top_artists"),
                    F.col("top_weekly_chart_points").alias("top_track_chart_points"))


def summary_with_top_track(life: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``mart_market_trends`` in one aggregate: the top track rides along as ``min(struct)``.

    Same result as the summary LEFT JOIN top-track (``join_top_track``), with
    one exchange instead of three.
    """
    best = F.min(F.struct(F.col("weekly_chart_points").isNull().alias("_none"), (-F.col("weekly_chart_points")).alias("_neg"), F.col("spotify_id").alias("_id"),
                          F.col("track_name").alias("_name"), F.col("artists").alias("_artists"),
                          F.col("weekly_chart_points").alias("_pts")))
    agg = life.groupBy("country", "chart_week").agg(*_summary(t), best.alias("_best"))
    return agg.select(*SUMMARY_COLUMNS,
                      F.col("_best._id").alias("top_spotify_id"),
                      F.col("_best._name").alias("top_track_name"),
                      F.col("_best._artists").alias("top_artists"),
                      F.col("_best._pts").alias("top_track_chart_points"))


def market_trends(life: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``mart_market_trends``: 23 columns."""
    return summary_with_top_track(life, t)


def join_top_track(summary: DataFrame, life: DataFrame) -> DataFrame:
    """``join_top_track``: summary LEFT JOIN the rank-1 rows on (market, week)."""
    return summary.join(top_track(life), ["country", "chart_week"], "left").select(*MKT_COLUMNS)


# The KPI catalog (name, tier, formula or definition, data requirement, computed).
KPI_CATALOG = [
    ("Chart Points", "Tier 1 - Real Spotify chart data",
     "201 - daily_rank, aggregated by track, market, and week", "Real Kaggle Spotify chart data", True),
    ("Week-over-Week Growth", "Tier 1 - Real Spotify chart data",
     "(this_week_chart_points - previous_week_chart_points) / previous_week_chart_points",
     "Real Kaggle Spotify chart data", True),
    ("Lifecycle Stage", "Tier 1 - Real Spotify chart data",
     "Classifies tracks as Debut, Growing, Peak, Declining, Revived, or Stable based on weekly chart movement",
     "Real Kaggle Spotify chart data", True),
    ("Catalog Revival Flag", "Tier 1 - Real Spotify chart data",
     "Flags tracks that return after a long gap in chart activity", "Real Kaggle Spotify chart data", True),
    ("Market Spike Flag", "Tier 1 - Real Spotify chart data",
     "Flags tracks where market-level growth is significantly above the selected-market average",
     "Real Kaggle Spotify chart data", True),
    ("Cross-Market Penetration", "Tier 1 - Real Spotify chart data",
     "Counts distinct countries where a track appears in the same chart week", "Real Kaggle Spotify chart data", True),
    ("Cost per Stream", "Tier 2 - Synthetic campaign data", "spend_eur / attributed_streams",
     "Synthetic campaign data linked to real track-market-date combinations", True),
    ("ROAS Proxy", "Tier 2 - Synthetic campaign data", "(attributed_streams * 0.004) / spend_eur",
     "Synthetic campaign data plus public stream value proxy", True),
    ("Lift vs Control", "Tier 2 - Synthetic campaign data",
     "campaign_market_wow_growth - control_market_avg_wow_growth",
     "Synthetic campaign data joined with real chart trend data", True),
    ("Skip Rate", "Tier 3 - Documented only", "skips / total_streams",
     "Requires Spotify for Artists or platform-level consumption data", False),
    ("Save Rate", "Tier 3 - Documented only", "saves / total_listeners or saves / total_streams",
     "Requires Spotify for Artists data", False),
    ("Monthly Listeners", "Tier 3 - Documented only", "Unique listeners over a rolling monthly window",
     "Requires Spotify for Artists data", False),
    ("D7 Retention", "Tier 3 - Documented only", "listeners returning seven days after first listening event",
     "Requires user-level listening data", False),
    ("Playlist Reach", "Tier 3 - Documented only", "Estimated listeners reachable through playlist placement",
     "Requires Spotify for Artists, Chartmetric, or internal label tools", False),
    ("CAC per Follower", "Tier 3 - Documented only", "campaign_spend / new_followers",
     "Requires internal campaign spend and follower growth data", False),
]

KPI_SCHEMA = T.StructType([
    T.StructField("kpi_name", T.StringType(), False),
    T.StructField("kpi_tier", T.StringType(), False),
    T.StructField("formula_or_definition", T.StringType(), False),
    T.StructField("data_source_requirement", T.StringType(), False),
    T.StructField("computed_in_project", T.BooleanType(), False),
])


def kpi_catalog(spark: SparkSession) -> DataFrame:
    """``kpi_catalog``: the 15 literal rows (a LocalRelation, one partition)."""
    return spark.createDataFrame(KPI_CATALOG, KPI_SCHEMA)
