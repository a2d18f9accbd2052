"""Campaign construction from chart anchors (the generator's table work).

The reference draws anchors and campaign parameters from a seeded random
generator on one machine.  Here the "draws" are deterministic functions of
the anchor row (an md5 order for sampling, integer arithmetic for the
parameters), so the construction is an ordinary distributed query whose
result does not depend on partitioning.  Documented divergence: anchors are
sampled without replacement (the reference samples with replacement).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.params import CHANNEL_CPM

ANCHOR_KEYS = ("spotify_id", "country", "snapshot_date")
CHANNELS = tuple(CHANNEL_CPM)  # fixed order: Spotify Ads, TikTok, Meta, Editorial Push


def anchor_dedup(charts: DataFrame) -> DataFrame:
    """``anchor_dedup``: one row per (item, market, date); the best-ranked row wins.

    An aggregate with ``min(struct(rank, ...))``: partial aggregation keeps a
    hot key from landing in one task (``dropDuplicates`` would pick any row).
    """
    rest = [c for c in charts.columns if c not in ANCHOR_KEYS]
    first = F.min(F.struct(F.col("daily_rank").alias("_r"), *[F.col(c) for c in rest if c != "daily_rank"],
                           F.col("daily_rank"))).alias("_row")
    return charts.groupBy(*ANCHOR_KEYS).agg(first).select(*ANCHOR_KEYS, *[f"_row.{c}" for c in rest]) \
        .select(*charts.columns)


def positive_movement(anchors: DataFrame) -> DataFrame:
    """``anchor_positive_movement``: rows whose daily movement is a number > 0."""
    return anchors.where(F.col("daily_movement").cast("string").try_cast("double") > 0)


def _draw_key(seed: int):
    return F.md5(F.concat_ws("#", F.lit(str(seed)), *[F.col(k).cast("string") for k in ANCHOR_KEYS]))


def anchor_sample(anchors: DataFrame, n: int = 50, share: float = 0.6, seed: int = 42) -> DataFrame:
    """``anchor_sample``: ``int(share*n)`` positive-movement anchors + the rest from all anchors.

    Each side is ``orderBy(md5 key).limit(k)`` — a distributed top-k, no
    global sort.  When fewer positive rows exist (none at all included), the
    random side fills up to n: the at most ``k + n`` picked rows are numbered
    (a window over a parameter-bounded set) and the first n kept.
    """
    k_pos = int(n * share)
    pos = positive_movement(anchors).withColumn("_draw", _draw_key(seed))
    pos_pick = pos.orderBy("_draw", *ANCHOR_KEYS).limit(k_pos) \
        .withColumn("generation_type", F.lit("movement_anchored")).withColumn("_side", F.lit(0))
    rnd = anchors.withColumn("_draw", _draw_key(seed + 1))
    rnd_pick = rnd.orderBy("_draw", *ANCHOR_KEYS).limit(n) \
        .withColumn("generation_type", F.lit("random_timing")).withColumn("_side", F.lit(1))
    cols = [*ANCHOR_KEYS, "track_name", "artists", "daily_rank", "generation_type", "_draw", "_side"]
    picks = pos_pick.select(*cols).unionByName(rnd_pick.select(*cols))
    order = Window.orderBy("_side", "_draw", *ANCHOR_KEYS)
    return picks.withColumn("_pick", F.row_number().over(order)).where(F.col("_pick") <= n) \
        .drop("_side", "_pick")


def _unit(expr, modulus: int):
    return F.pmod(expr, F.lit(modulus))


def campaign_dates(sample: DataFrame) -> DataFrame:
    """``campaign_dates``: start = anchor - lead days, end = start + duration.

    lead: 2-3 days for movement-anchored, 0-10 otherwise; duration 7-30 days.
    """
    x = F.unix_date("snapshot_date") + F.col("daily_rank")
    lead = F.when(F.col("generation_type") == "movement_anchored", 2 + _unit(x, 2)).otherwise(_unit(x, 11))
    start = F.date_sub("snapshot_date", lead.cast("int"))
    return (sample.withColumn("campaign_start_date", start)
                  .withColumn("campaign_end_date", F.date_add(start, (7 + _unit(x * 7, 24)).cast("int"))))


def channel_cpm(channel="channel"):
    """CPM of a channel (a literal CASE, no lookup join)."""
    expr = None
    for name, cpm in CHANNEL_CPM.items():
        expr = (F.when(F.col(channel) == name, F.lit(cpm)) if expr is None
                else expr.when(F.col(channel) == name, F.lit(cpm)))
    return expr


def campaign_funnel(df: DataFrame) -> DataFrame:
    """``campaign_funnel``: impressions, clicks, streams from spend, CPM and rates.

    impressions = int(spend / CPM * 1000 * jitter); clicks = int(impressions * ctr);
    streams = max(1, int(clicks * conversion * multiplier)); ctr and
    conversion are reported rounded to 4 places.  Inputs are the columns
    ``channel, spend_eur, jitter, ctr_raw, conversion_raw, multiplier``.
    """
    impressions = F.floor(F.col("spend_eur") / channel_cpm() * F.lit(1000.0) * F.col("jitter")).cast("long")
    clicks = F.floor(F.col("impressions") * F.col("ctr_raw")).cast("long")
    streams = F.greatest(F.lit(1).cast("long"),
                         F.floor(F.col("clicks") * F.col("conversion_raw") * F.col("multiplier")).cast("long"))
    return (df.withColumn("impressions", impressions)
              .withColumn("clicks", clicks)
              .withColumn("attributed_streams", streams)
              .withColumn("ctr", F.round("ctr_raw", 4))
              .withColumn("conversion_rate", F.round("conversion_raw", 4)))


def draw_parameters(df: DataFrame) -> DataFrame:
    """Deterministic stand-ins for the generator's random draws (integer arithmetic)."""
    x = F.unix_date("snapshot_date") * 7919 + F.col("daily_rank") * 104729
    ch = _unit(x, 4)
    channel = F.when(ch == 0, CHANNELS[0]).when(ch == 1, CHANNELS[1]).when(ch == 2, CHANNELS[2]).otherwise(CHANNELS[3])
    return (df.withColumn("channel", channel)
              .withColumn("spend_eur", (500 + _unit(x, 49500)).cast("double") + _unit(x, 100).cast("double") / 100.0)
              .withColumn("jitter", F.lit(0.85) + _unit(x, 31).cast("double") / 100.0)
              .withColumn("ctr_raw", F.lit(0.005) + _unit(x, 26).cast("double") / 1000.0)
              .withColumn("conversion_raw", F.lit(0.05) + _unit(x, 21).cast("double") / 100.0)
              .withColumn("multiplier", F.lit(1.0) + _unit(x, 21).cast("double") / 10.0))


def generate_campaigns(anchors: DataFrame, n: int = 50, share: float = 0.6, seed: int = 42) -> DataFrame:
    """The generated campaign table (16 staged columns) from chart anchors."""
    sample = campaign_dates(anchor_sample(anchor_dedup(anchors), n, share, seed))
    ordinal = F.row_number().over(Window.orderBy(F.col("generation_type"), "_draw"))  # n rows only
    funnel = campaign_funnel(draw_parameters(sample))
    return funnel.select(
        F.format_string("CMP_%03d", ordinal).alias("campaign_id"),
        "spotify_id", "track_name", "artists", "country", "snapshot_date", "campaign_start_date",
        "campaign_end_date", "channel", "spend_eur", "impressions", "clicks", "ctr", "conversion_rate",
        "attributed_streams", "generation_type")
