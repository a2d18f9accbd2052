"""Hot keys: AQE splits them, results stay whole and equal to the plain forms."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import weekly_frame
from test_campaigns import CAMP_SCHEMA
from tidemark.operators import campaigns as C
from tidemark.operators import lifecycle as L
from tidemark.operators import marts as M
from tidemark.operators import weekly as W
from tidemark.operators.ranking import top1_per_group, window_row_number

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _life(spark):
    rows = []
    for m in range(12):                       # one hot item in 12 markets, two weeks
        rows += [("HOT", f"M{m:02d}", "2025-01-06", 100), ("HOT", f"M{m:02d}", "2025-01-13", 100 + 10 * m)]
    rows += [("COLD", "M00", "2025-01-06", 50), ("COLD", "M00", "2025-01-13", 75)]
    return L.lifecycle(W.weekly_growth(weekly_frame(spark, rows), keep_history=True))


def test_hot_item_week_campaigns(spark):
    life = _life(spark)
    day = dt.date(2025, 1, 14)
    rows = [(f"C{i:04d}", "HOT" if i % 10 else "COLD", "t", "a", f"M{i % 12:02d}" if i % 10 else "M00", day,
             None, None, "Meta", 10.0 + i, 0, 0, 0.0, 0.0, 100 + i, "random_timing") for i in range(1500)]
    camps = spark.createDataFrame(rows, CAMP_SCHEMA).repartition(6)

    def run():
        fused = C.campaign_market_and_control(camps, life).select("campaign_id", "control_market_avg_wow_growth")
        theta = C.control_market_growth(camps, life)
        return fused.collect(), theta.collect(), C.campaign_performance(camps, life).count()

    fused, theta, n = _with_conf(spark, SKEW_CONF, run)
    assert n == 1500                                           # whole: nothing dropped or capped
    t = {r.campaign_id: r.control_market_avg_wow_growth for r in theta}
    f = {r.campaign_id: r.control_market_avg_wow_growth for r in fused}
    # COLD campaigns (every 10th) have no other market: no control row, NULL in the mart
    assert len(t) == 1350 and len(f) == 1500
    assert all(abs(f[k] - v) < 1e-12 for k, v in t.items())
    assert all(f[k] is None for k in f if k not in t)


def test_top_track_and_rank_on_hot_market_week(spark):
    df = spark.range(0, 3000).select(
        F.lit("HOTMARKET").alias("country"), F.lit(dt.date(2025, 1, 6)).alias("chart_week"),
        F.format_string("item%05d", F.col("id")).alias("spotify_id"),
        (F.col("id") % 97).alias("weekly_chart_points"))
    ranked = _with_conf(spark, SKEW_CONF, lambda: M.with_market_rank(df).collect())
    plain = window_row_number(df, ["country", "chart_week"],
                              [("weekly_chart_points", False), ("spotify_id", True)], "market_week_rank").collect()
    assert sorted((r.spotify_id, r.market_week_rank) for r in ranked) == \
        sorted((r.spotify_id, r.market_week_rank) for r in plain)
    top = top1_per_group(df, ["country", "chart_week"], "weekly_chart_points", "spotify_id",
                           ["spotify_id"]).first()
    assert top.top_spotify_id == "item00096"
