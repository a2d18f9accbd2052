"""The shipped 50-campaign file through the CSV reader, staging and the campaign math."""

import os

from pyspark.sql import functions as F

from tidemark.functions.columns import cost_per_stream, roas_proxy
from tidemark.operators import campaigns as C
from tidemark.operators import ingest as I
from tidemark.operators import quality as Q
from tidemark.operators import staging as S
from tidemark.sources import files as FS

CSV = os.path.join(os.path.dirname(__file__), "data", "campaigns.csv")


def _staged(spark):
    return S.stage_campaigns(FS.read_csv(spark, CSV, I.CAMPAIGN_COLUMNS))


def test_counts_and_totals(spark):
    camps = _staged(spark)
    assert camps.count() == 50
    assert camps.select("campaign_id").distinct().count() == 50
    assert Q.unique(camps, "campaigns", "campaign_id").first().failing_rows == 0
    mix = {r.generation_type: r.row_count for r in Q.generation_mix(camps).collect()}
    assert mix == {"movement_anchored": 30, "random_timing": 20}
    tot = camps.agg(F.sum("spend_eur").alias("s"), F.sum("attributed_streams").alias("st"),
                    F.sum("impressions").alias("i"), F.sum("clicks").alias("c")).first()
    assert round(tot.s, 2) == 1274820.97 and (tot.st, tot.i, tot.c) == (1651456, 259780294, 5111367)


def test_campaign_math_goldens(spark):
    m = _staged(spark).withColumn("cost_per_stream", cost_per_stream()).withColumn("roas_proxy", roas_proxy())
    agg = m.agg(F.avg("roas_proxy").alias("r"), F.avg("cost_per_stream").alias("c"),
                F.max("roas_proxy").alias("mx")).first()
    assert round(agg.r, 6) == 0.004827 and round(agg.c, 6) == 1.751510 and round(agg.mx, 6) == 0.025544
    bench = {r.channel: round(r.channel_avg_cost_per_stream, 6) for r in C.channel_benchmarks(m).collect()}
    assert bench == {"Editorial Push": 0.401803, "Meta": 1.389018, "Spotify Ads": 2.163008, "TikTok": 2.123020}
    scored = C.join_channel_benchmark(m).withColumn(
        "alert", F.col("cost_per_stream") > 2 * F.col("channel_avg_cost_per_stream"))
    alerts = sorted(r.campaign_id for r in scored.where("alert").collect())
    assert alerts == ["CMP_010", "CMP_011", "CMP_018", "CMP_039"]
    roas = {r.channel: round(r.roas_proxy, 6) for r in m.groupBy("channel").agg(F.avg("roas_proxy").alias("roas_proxy")).collect()}
    assert roas == {"Editorial Push": 0.013359, "Meta": 0.004192, "Spotify Ads": 0.003129, "TikTok": 0.003727}
    by_country = {r.country: r["count"] for r in m.groupBy("country").count().collect()}
    assert by_country == {"BR": 14, "FR": 9, "DE": 6, "ES": 6, "JP": 6, "IT": 5, "US": 4}
