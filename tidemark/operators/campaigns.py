"""Campaign scoring: market join, control markets, cost, return, benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (campaign_efficiency_alert, campaign_performance_signal,
                                        cost_per_stream, lift_vs_control, roas_proxy, week_of)
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds
from tidemark.session import write_once

CAMPAIGN_COLUMNS = (
    "campaign_id", "spotify_id", "track_name", "artists", "country", "snapshot_date",
    "campaign_start_date", "campaign_end_date", "channel", "spend_eur", "impressions", "clicks",
    "ctr", "conversion_rate", "attributed_streams", "generation_type")

#: A growth rate as a decimal: all 17 digits of a DOUBLE from 1e-7 on, up to 1e10; sums have four digits more.
EXACT = "decimal(34,24)"

#: Rows of a table that campaigns look up by key, up to which every task holds it whole (about 60 MB
#: of lifecycle rows) and the campaigns stay where they are; a larger one is joined by a shuffle.
LOOKUP_ROWS = 500_000

BASE_COLUMNS = CAMPAIGN_COLUMNS[:6] + ("campaign_week",) + CAMPAIGN_COLUMNS[6:]

#: What ``join_control`` reads of a campaign.
CONTROL_COLUMNS = ("campaign_id", "spotify_id", "country", "snapshot_date")

MARKET_COLUMNS = ("campaign_market_chart_points", "campaign_market_wow_growth",
                  "campaign_market_lifecycle_stage", "campaign_market_spike_flag", "cross_market_count")

CAMP_COLUMNS = BASE_COLUMNS + (
    "campaign_market_chart_points", "campaign_market_wow_growth", "control_market_avg_wow_growth",
    "lift_vs_control", "campaign_market_lifecycle_stage", "campaign_market_spike_flag",
    "cross_market_count", "cost_per_stream", "roas_proxy", "channel_avg_cost_per_stream",
    "campaign_efficiency_alert", "campaign_performance_signal")


def exact_rate(name: str) -> Column:
    return F.col(name).try_cast(EXACT)


def looked_up(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as the side of a join that is broadcast if it has at most ``rows`` (``LOOKUP_ROWS``) rows.

    Markets x weeks x items grow far slower than campaigns, and campaign rows are the widest: a
    shuffle of them costs more than all else.  Rows are counted, not estimated (one job; a count of
    a written table reads no rows).
    """
    most = LOOKUP_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def campaign_base(campaigns: DataFrame) -> DataFrame:
    """``campaign_week``: the Monday week of the anchor date."""
    return campaigns.withColumn("campaign_week", week_of("snapshot_date")).select(*BASE_COLUMNS)


def _life_side(life: DataFrame) -> DataFrame:
    return life.select(F.col("spotify_id").alias("_r_id"), F.col("country").alias("_r_country"),
                       F.col("chart_week").alias("_r_week"),
                       F.col("weekly_chart_points").alias("campaign_market_chart_points"),
                       F.col("wow_growth_rate").alias("campaign_market_wow_growth"),
                       F.col("lifecycle_stage").alias("campaign_market_lifecycle_stage"),
                       F.col("market_spike_flag").alias("campaign_market_spike_flag"),
                       "cross_market_count")


def join_campaign_market(campaigns: DataFrame, life: DataFrame) -> DataFrame:
    """``join_campaign_market``: LEFT JOIN the lifecycle row of the campaign's own market-week."""
    c = campaign_base(campaigns)
    r = looked_up(_life_side(life))
    cond = ((c.spotify_id == r._r_id) & (c.country == r._r_country) & (c.campaign_week == r._r_week))
    return c.join(r, cond, "left").select(*BASE_COLUMNS, *MARKET_COLUMNS)


def join_control(campaigns: DataFrame, life: DataFrame) -> DataFrame:
    """``join_control``: same item and week, *other* markets, growth known.

    Equi keys (item, week) drive a hash/sort-merge join; ``country <>`` is a
    residual.  Fan-out per campaign is at most the number of markets.  Only the
    rows that the query returns leave the join: the campaigns are not shuffled
    as long as the lifecycle rows can be looked up.
    """
    c = campaigns.select("campaign_id", "spotify_id", "country", week_of("snapshot_date").alias("campaign_week"))
    r = life.select(F.col("spotify_id").alias("_r_id"), F.col("chart_week").alias("_r_week"),
                    F.col("country").alias("control_country"), "wow_growth_rate") \
        .where(F.col("wow_growth_rate").isNotNull())
    r = looked_up(r)
    cond = ((c.spotify_id == r._r_id) & (c.campaign_week == r._r_week) & (c.country != r.control_country))
    return c.join(r, cond, "inner").select("campaign_id", "control_country", "wow_growth_rate")


def market_totals(life: DataFrame) -> DataFrame:
    """One row per item-week: exact sum and number of the growth rates of all its markets."""
    return life.where(F.col("country").isNotNull()) \
        .groupBy(F.col("spotify_id").alias("_t_id"), F.col("chart_week").alias("_t_week")) \
        .agg(F.sum(exact_rate("wow_growth_rate")).alias("_total"), F.count("wow_growth_rate").alias("_rates"))


def with_control_totals(campaigns: DataFrame, life: DataFrame) -> DataFrame:
    """``join_campaign_market`` plus sum and number of the growth rates of the *other* markets.

    Two 1:1 joins: the own row by (item, market, week), and the totals by (item, week), of which
    the own rate is taken away.  The sums are exact decimals, so nothing is lost in the
    difference, and no campaign meets more than one row of either side.  A campaign without a
    market has no other markets, as with ``<>``.
    """
    t = looked_up(market_totals(life))
    m = join_campaign_market(campaigns, life)
    known = F.col("campaign_market_wow_growth").isNotNull()
    own = F.coalesce(exact_rate("campaign_market_wow_growth"), F.lit(0).cast(EXACT))
    there = F.col("country").isNotNull()
    return m.join(t, (m.spotify_id == t._t_id) & (m.campaign_week == t._t_week), "left").select(
        *m.columns,
        F.when(there, F.col("_total") - own).alias("_control_sum"),
        F.when(there, F.col("_rates") - known.cast("long")).alias("_control_n"))


def _mean(total: Column, n: Column) -> Column:
    """Decimal division, so that the mean of equal rates is that rate and a lift of zero stays zero."""
    return F.when(n > 0, (total / n.cast("decimal(4,0)")).cast("double"))


def control_market_growth(campaigns: DataFrame, life: DataFrame) -> DataFrame:
    """``control_market_growth``: AVG growth of the other markets, per campaign id, without ``join_control``'s fan-out."""
    return with_control_totals(campaigns, life).where(F.col("_control_n") > 0).groupBy("campaign_id") \
        .agg(_mean(F.sum("_control_sum"), F.sum("_control_n")).alias("control_market_avg_wow_growth"))


def shared_ids(campaigns: DataFrame) -> DataFrame:
    """_hash: hashes of the campaign ids on more than one row (and of few others, where two ids meet)."""
    return campaigns.where(F.col("campaign_id").isNotNull()).groupBy(F.xxhash64("campaign_id").alias("_hash")) \
        .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")


def join_control_back(campaigns: DataFrame, life: DataFrame) -> DataFrame:
    """``join_control_back``: campaign + market columns LEFT JOIN the control average.

    The average is one of a campaign id.  An id on one row has its row's own average, so only ids
    on several rows are grouped and joined back; the wide rows need no shuffle by id for the rest.
    """
    m = with_control_totals(campaigns, life)
    shared = looked_up(write_once(shared_ids(campaigns), "shared-ids"))
    some = campaigns.join(shared, F.xxhash64(campaigns.campaign_id) == shared._hash, "left_semi")
    known = F.col("_control_n") > 0
    own = _mean(*[F.when(F.col("campaign_id").isNotNull(), F.col(c)) for c in ("_control_sum", "_control_n")])
    of_id = with_control_totals(some, life).groupBy(F.col("campaign_id").alias("_id")) \
        .agg(_mean(F.sum(F.when(known, F.col("_control_sum"))), F.sum(F.when(known, F.col("_control_n")))).alias("_of_id"))
    ids = looked_up(write_once(of_id, "control-of-shared-ids"))
    return m.join(ids, m.campaign_id == ids._id, "left") \
        .withColumn("control_market_avg_wow_growth", F.when(F.col("_id").isNotNull(), F.col("_of_id")).otherwise(own)) \
        .select("campaign_id", *[c for c in (*BASE_COLUMNS, *MARKET_COLUMNS) if c != "campaign_id"], "control_market_avg_wow_growth") \
        .withColumn("lift_vs_control", lift_vs_control())


def campaign_market_and_control(campaigns: DataFrame, life: DataFrame) -> DataFrame:
    """Own-market columns and control average of every campaign row (rows that repeat stay as they are)."""
    return with_control_totals(campaigns, life).select(
        *BASE_COLUMNS, *MARKET_COLUMNS, _mean(F.col("_control_sum"), F.col("_control_n")).alias("control_market_avg_wow_growth"))


def campaign_metrics(campaigns: DataFrame, life: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Campaign + market + control + lift + ``cost_per_stream`` + ``roas_proxy``."""
    m = campaign_market_and_control(campaigns, life)
    return (m.withColumn("lift_vs_control", lift_vs_control())
             .withColumn("cost_per_stream", cost_per_stream())
             .withColumn("roas_proxy", roas_proxy(t=t)))


def channel_benchmarks(metrics: DataFrame) -> DataFrame:
    """``channel_benchmarks``: unweighted mean cost per stream per channel (nulls skipped)."""
    return metrics.where(F.col("cost_per_stream").isNotNull()).groupBy("channel") \
        .agg(F.avg("cost_per_stream").alias("channel_avg_cost_per_stream"))


def join_channel_benchmark(metrics: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``join_channel_benchmark``: LEFT JOIN the benchmark by channel.

    ``rows`` (default ``metrics``) is what the benchmark averages over.  Cost
    per stream depends on the campaign row alone and the market / control
    joins are 1:1 per campaign row at the unique weekly grain, so the mart
    passes the plain campaign rows: the benchmark then never re-runs the
    market join.  The benchmark is written before the join is planned: it has
    one row per channel, and a shuffle by channel would put all rows of a
    channel into one task.
    """
    src = rows if rows is not None else metrics
    if "cost_per_stream" not in src.columns:
        src = src.withColumn("cost_per_stream", cost_per_stream())
    b = looked_up(write_once(channel_benchmarks(src), "benchmarks").withColumnRenamed("channel", "_b_channel"))
    return metrics.join(b, metrics.channel == b._b_channel, "left").drop("_b_channel")


def campaign_performance(campaigns: DataFrame, life: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``mart_campaign_performance``: 29 columns, one row per campaign row."""
    scored = join_channel_benchmark(campaign_metrics(campaigns, life, t), campaign_base(campaigns))
    return (scored.withColumn("campaign_efficiency_alert", campaign_efficiency_alert(t=t))
                  .withColumn("campaign_performance_signal", campaign_performance_signal(t=t))
                  .select(*CAMP_COLUMNS))
