"""Dashboard queries: filters over the marts and the rollups each tab shows.

Each query returns a small DataFrame; nothing is collected inside.  Top-k
queries end in ``orderBy(...).limit(k)``, which Spark plans as a
distributed TakeOrderedAndProject (k rows per task, then k overall).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import lift_bubble_size
from tidemark.params import DEFAULT_THRESHOLDS, DashboardFilter, Thresholds


def filter_guard(f: DashboardFilter) -> DashboardFilter:
    """``dash_filter_guard``: reject an empty market list or a half-open range."""
    f.validate()
    return f


def _in_markets(df: DataFrame, f: DashboardFilter) -> DataFrame:
    """No list selects every market that has a name; rows without one are never shown."""
    country = F.col("country")
    return df.where(country.isNotNull() if f.countries is None else country.isin(list(f.countries)))


def _in_range(df: DataFrame, f: DashboardFilter, col: str = "chart_week") -> DataFrame:
    out = _in_markets(df, f)
    if f.start is not None:
        out = out.where(F.col(col).between(F.lit(f.start).cast("date"), F.lit(f.end).cast("date")))
    return out


def filter_rep(rep: DataFrame, f: DashboardFilter) -> DataFrame:
    """``dash_filter_rep``: markets IN list AND week BETWEEN start AND end (inclusive)."""
    return _in_range(rep, filter_guard(f))


def filter_mkt(mkt: DataFrame, f: DashboardFilter) -> DataFrame:
    """``dash_filter_mkt``."""
    return _in_range(mkt, filter_guard(f))


def filter_camp(camp: DataFrame, f: DashboardFilter) -> DataFrame:
    """``dash_filter_camp``: markets only — the campaign tab has no date filter."""
    return _in_markets(camp, filter_guard(f))


def date_bounds(rep: DataFrame) -> DataFrame:
    """``dash_date_bounds``."""
    return rep.agg(F.min("chart_week").alias("min_date"), F.max("chart_week").alias("max_date"))


def countries(rep: DataFrame) -> DataFrame:
    """``dash_countries``: distinct markets, nulls dropped, sorted."""
    return rep.select("country").where(F.col("country").isNotNull()).distinct().orderBy("country")


def rep_headline(rep_f: DataFrame) -> DataFrame:
    """``dash_rep_headline``: distinct items, mean growth, revival and spike rows."""
    return rep_f.agg(F.countDistinct("spotify_id").alias("total_tracks"),
                     F.avg("wow_growth_rate").alias("avg_wow_growth"),
                     F.count_if(F.col("catalog_revival_flag")).alias("catalog_revivals"),
                     F.count_if(F.col("market_spike_flag")).alias("market_spikes"))


def lifecycle_counts(rep_f: DataFrame) -> DataFrame:
    """``dash_lifecycle_counts``: rows per stage (null stage dropped, as pandas groupby does)."""
    return rep_f.where(F.col("lifecycle_stage").isNotNull()).groupBy("lifecycle_stage") \
        .agg(F.count(F.lit(1)).alias("row_count"))


def top_tracks(rep_f: DataFrame, k: int = 10) -> DataFrame:
    """``dash_top_tracks``: top k (name, artists) by summed weekly points."""
    return (rep_f.where(F.col("track_name").isNotNull() & F.col("artists").isNotNull())
                 .groupBy("track_name", "artists")
                 .agg(F.sum("weekly_chart_points").cast("long").alias("weekly_chart_points"))
                 .orderBy(F.col("weekly_chart_points").desc(), "track_name", "artists")
                 .limit(k))


SIGNAL_COLUMNS = ("track_name", "artists", "country", "chart_week", "weekly_chart_points",
                  "wow_growth_rate", "lifecycle_stage", "repertoire_signal", "cross_market_count")


def top_signals(rep_f: DataFrame, k: int = 50) -> DataFrame:
    """``dash_top_signals``: the k rows with most weekly points (ties by item, market, week)."""
    return (rep_f.orderBy(F.col("weekly_chart_points").desc(), "spotify_id", "country", "chart_week")
                 .limit(k).select(*SIGNAL_COLUMNS))


def market_series(mkt_f: DataFrame) -> DataFrame:
    """``dash_market_series``."""
    return mkt_f.select("country", "chart_week", "total_chart_points").orderBy("country", "chart_week")


def latest_week(mkt_f: DataFrame) -> DataFrame:
    """``dash_latest_week``: rows of the latest week (the max is a scalar subquery)."""
    latest = mkt_f.select(F.max("chart_week")).scalar()
    return (mkt_f.where(F.col("chart_week") == latest)
                 .select("country", "chart_week", "total_chart_points")
                 .orderBy(F.col("total_chart_points").desc(), "country"))


MARKET_TABLE_COLUMNS = ("country", "chart_week", "tracks_tracked", "total_chart_points", "growing_tracks",
                        "declining_tracks", "market_spike_count", "top_track_name", "top_artists")


def market_table(mkt_f: DataFrame) -> DataFrame:
    """``dash_market_table``: by week desc, total points desc."""
    return mkt_f.select(*MARKET_TABLE_COLUMNS) \
        .orderBy(F.col("chart_week").desc(), F.col("total_chart_points").desc(), "country")


def market_headline(mkt_f: DataFrame) -> DataFrame:
    """``dash_market_headline``: sums of spikes and multi-market counts; mean of averages."""
    return mkt_f.agg(F.sum("market_spike_count").cast("long").alias("total_market_spikes"),
                     F.sum("multi_market_tracks").cast("long").alias("multi_market_tracks"),
                     F.sum("cross_market_champions").cast("long").alias("cross_market_champions"),
                     F.avg("avg_wow_growth_rate").alias("avg_market_growth"))


def campaign_headline(camp_f: DataFrame) -> DataFrame:
    """``dash_campaign_headline``; spend is summed as exact decimals (order independent)."""
    return camp_f.agg(F.sum(F.col("spend_eur").cast("decimal(18,4)")).cast("double").alias("total_spend"),
                      F.avg("roas_proxy").alias("avg_roas"),
                      F.avg("cost_per_stream").alias("avg_cps"),
                      F.countDistinct("campaign_id").alias("campaigns"))


def channel_roas(camp_f: DataFrame) -> DataFrame:
    """``dash_channel_roas``: mean ROAS per channel."""
    return camp_f.where(F.col("channel").isNotNull()).groupBy("channel") \
        .agg(F.avg("roas_proxy").alias("roas_proxy"))


CAMPAIGN_TABLE_COLUMNS = ("campaign_id", "track_name", "artists", "country", "channel", "spend_eur",
                          "attributed_streams", "cost_per_stream", "roas_proxy", "lift_vs_control",
                          "campaign_efficiency_alert", "campaign_performance_signal")


def campaign_table(camp_f: DataFrame) -> DataFrame:
    """``dash_campaign_table``: by ROAS desc, missing ROAS last."""
    return camp_f.select(*CAMPAIGN_TABLE_COLUMNS) \
        .orderBy(F.col("roas_proxy").desc_nulls_last(), "campaign_id")


def spend_streams(camp_f: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``dash_spend_streams``: scatter data with ``lift_bubble_size`` as ``lift_size``."""
    return camp_f.select("campaign_id", "spend_eur", "attributed_streams", "channel",
                         lift_bubble_size(t=t).alias("lift_size"), "track_name", "artists", "country",
                         "lift_vs_control", "campaign_performance_signal")


def kpi_sorted(kpi: DataFrame) -> DataFrame:
    """``dash_kpi_catalog``: catalog ordered by tier, then name."""
    return kpi.orderBy("kpi_tier", "kpi_name")
