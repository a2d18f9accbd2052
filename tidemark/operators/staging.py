"""Staging: typed, trimmed views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _trim(c: str):
    # SQL TRIM: leading and trailing spaces only.
    return F.trim(F.col(c))


def _as(c: str, type_: str):
    return F.col(c).cast("string").try_cast(type_) if type_ != "date" else \
        F.try_to_timestamp(F.col(c).cast("string"), F.lit("yyyy-MM-dd")).cast("date")


def _int(c: str):
    # A whole number of 64 bits from '3', '3.0' or '3.7' (rounded half away from zero).
    return F.round(F.col(c).cast("string").try_cast("decimal(38,6)"), 0).try_cast("bigint")


def stage_charts(raw: DataFrame, drop_blank_keys: bool = False) -> DataFrame:
    """``stg_charts``: 25 typed columns; rows need id, country and date (as raw values).

    The null test looks at the raw columns, so an id of spaces becomes ''
    and survives unless ``drop_blank_keys``.
    """
    out = (raw.where(F.col("SPOTIFY_ID").isNotNull() & F.col("COUNTRY").isNotNull()
                     & F.col("SNAPSHOT_DATE").isNotNull())
           .select(_trim("SPOTIFY_ID").alias("spotify_id"),
                   _trim("NAME").alias("track_name"),
                   _trim("ARTISTS").alias("artists"),
                   _int("DAILY_RANK").alias("daily_rank"),
                   _int("DAILY_MOVEMENT").alias("daily_movement"),
                   _int("WEEKLY_MOVEMENT").alias("weekly_movement"),
                   F.upper(_trim("COUNTRY")).alias("country"),
                   _as("SNAPSHOT_DATE", "date").alias("snapshot_date"),
                   _int("POPULARITY").alias("popularity"),
                   _as("IS_EXPLICIT", "boolean").alias("is_explicit"),
                   _int("DURATION_MS").alias("duration_ms"),
                   _trim("ALBUM_NAME").alias("album_name"),
                   _as("ALBUM_RELEASE_DATE", "date").alias("album_release_date"),
                   _as("DANCEABILITY", "double").alias("danceability"),
                   _as("ENERGY", "double").alias("energy"),
                   _int("KEY").alias("musical_key"),
                   _as("LOUDNESS", "double").alias("loudness"),
                   _int("MODE").alias("mode"),
                   _as("SPEECHINESS", "double").alias("speechiness"),
                   _as("ACOUSTICNESS", "double").alias("acousticness"),
                   _as("INSTRUMENTALNESS", "double").alias("instrumentalness"),
                   _as("LIVENESS", "double").alias("liveness"),
                   _as("VALENCE", "double").alias("valence"),
                   _as("TEMPO", "double").alias("tempo"),
                   _int("TIME_SIGNATURE").alias("time_signature")))
    if drop_blank_keys:
        out = out.where((F.col("spotify_id") != "") & (F.col("country") != ""))
    return out


def stage_campaigns(raw: DataFrame) -> DataFrame:
    """``stg_campaigns``: 16 typed columns; rows need the four keys."""
    return (raw.where(F.col("CAMPAIGN_ID").isNotNull() & F.col("SPOTIFY_ID").isNotNull()
                      & F.col("COUNTRY").isNotNull() & F.col("SNAPSHOT_DATE").isNotNull())
            .select(_trim("CAMPAIGN_ID").alias("campaign_id"),
                    _trim("SPOTIFY_ID").alias("spotify_id"),
                    _trim("TRACK_NAME").alias("track_name"),
                    _trim("ARTISTS").alias("artists"),
                    F.upper(_trim("COUNTRY")).alias("country"),
                    _as("SNAPSHOT_DATE", "date").alias("snapshot_date"),
                    _as("CAMPAIGN_START_DATE", "date").alias("campaign_start_date"),
                    _as("CAMPAIGN_END_DATE", "date").alias("campaign_end_date"),
                    _trim("CHANNEL").alias("channel"),
                    _as("SPEND_EUR", "double").alias("spend_eur"),
                    _int("IMPRESSIONS").alias("impressions"),
                    _int("CLICKS").alias("clicks"),
                    _as("CTR", "double").alias("ctr"),
                    _as("CONVERSION_RATE", "double").alias("conversion_rate"),
                    _int("ATTRIBUTED_STREAMS").alias("attributed_streams"),
                    _trim("GENERATION_TYPE").alias("generation_type")))
