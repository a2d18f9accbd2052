"""Ingestion cleaning of raw chart and campaign files (before the raw tables).

The reference streams a CSV through pandas in 100,000-row chunks in two
passes (max date, then clean + filter).  Here the file is one partitioned
scan: the max date is a scalar subquery (one tiny exchange), and the cleaning is a projection + filter that Spark runs per
partition with codegen.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import parse_date, strip_text, to_int, to_number, upper_code
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds

# Column lists of the chart file.
CHART_TEXT_COLUMNS = ("spotify_id", "name", "artists", "country", "album_name")
CHART_INT_COLUMNS = ("daily_rank", "daily_movement", "weekly_movement", "popularity", "duration_ms",
                     "key", "mode", "time_signature")
CHART_FLOAT_COLUMNS = ("danceability", "energy", "loudness", "speechiness", "acousticness",
                       "instrumentalness", "liveness", "valence", "tempo")
CHART_COLUMNS = (
    "spotify_id", "name", "artists", "daily_rank", "daily_movement", "weekly_movement", "country",
    "snapshot_date", "popularity", "is_explicit", "duration_ms", "album_name", "album_release_date",
    "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "time_signature")
CHART_KEYS = ("spotify_id", "country", "snapshot_date")

# Column lists of the campaign file.
CAMPAIGN_TEXT_COLUMNS = ("CAMPAIGN_ID", "SPOTIFY_ID", "TRACK_NAME", "ARTISTS", "COUNTRY", "CHANNEL",
                         "GENERATION_TYPE")
CAMPAIGN_DATE_COLUMNS = ("SNAPSHOT_DATE", "CAMPAIGN_START_DATE", "CAMPAIGN_END_DATE")
CAMPAIGN_FLOAT_COLUMNS = ("SPEND_EUR", "CTR", "CONVERSION_RATE")
CAMPAIGN_LONG_COLUMNS = ("IMPRESSIONS", "CLICKS", "ATTRIBUTED_STREAMS")
CAMPAIGN_COLUMNS = ("CAMPAIGN_ID", "SPOTIFY_ID", "TRACK_NAME", "ARTISTS", "COUNTRY", "SNAPSHOT_DATE",
                    "CAMPAIGN_START_DATE", "CAMPAIGN_END_DATE", "CHANNEL", "SPEND_EUR", "IMPRESSIONS",
                    "CLICKS", "CTR", "CONVERSION_RATE", "ATTRIBUTED_STREAMS", "GENERATION_TYPE")
CAMPAIGN_KEYS = ("CAMPAIGN_ID", "SPOTIFY_ID", "COUNTRY", "SNAPSHOT_DATE")


NO_DATE = "the chart file has no row with a date that can be read"


def max_date(raw: DataFrame, col: str = "snapshot_date") -> DataFrame:
    """``ing_max_date``: latest parsable date over ALL rows (one-row DataFrame)."""
    return raw.agg(F.max(parse_date(col)).alias("max_date"))


def require_max_date(raw: DataFrame, col: str = "snapshot_date"):
    """The max date as a Python value; raises when no row has a valid date."""
    value = max_date(raw, col).first()["max_date"]
    if value is None:
        raise ValueError(NO_DATE)
    return value


def checked_bounds(raw: DataFrame, col: str = "snapshot_date") -> DataFrame:
    """``max_date`` that fails when the query runs if no row has a valid date (lazy, no extra job)."""
    return max_date(raw, col).select(F.coalesce("max_date", F.raise_error(F.lit(NO_DATE)).cast("date")).alias("max_date"))


def strip_columns(raw: DataFrame, columns: Sequence[str] = CHART_TEXT_COLUMNS) -> DataFrame:
    """``ing_strip_text``: strip Unicode whitespace from the listed text columns."""
    return raw.withColumns({c: strip_text(c) for c in columns if c in raw.columns})


def upper_country(df: DataFrame, col: str = "country") -> DataFrame:
    """``ing_upper_country``."""
    return df.withColumn(col, upper_code(col))


def parse_dates(df: DataFrame, columns: Sequence[str] = ("snapshot_date", "album_release_date")) -> DataFrame:
    """``ing_parse_dates``: bad or partial dates become null."""
    return df.withColumns({c: parse_date(c) for c in columns})


def drop_missing_keys(df: DataFrame, keys: Sequence[str] = CHART_KEYS) -> DataFrame:
    """``ing_drop_missing_keys``."""
    return df.dropna(subset=list(keys))


def market_filter(df: DataFrame, markets, col: str = "country") -> DataFrame:
    """``ing_market_filter``: keep the listed markets.

    A list becomes an IN predicate (pushed to a parquet scan); a one-column
    DataFrame of market codes becomes a left-semi join, which the planner
    broadcasts when the measured size is small and shuffles otherwise.
    """
    if isinstance(markets, DataFrame):
        m = markets.select(F.col(markets.columns[0]).alias("_market")).distinct()
        return df.join(m, F.col(col) == F.col("_market"), "left_semi")
    return df.where(F.col(col).isin(list(markets)))


def date_window(df: DataFrame, bounds: DataFrame, days_back: int, col: str = "snapshot_date") -> DataFrame:
    """``ing_date_window``: max - days_back <= date <= max, both inclusive.

    ``bounds`` is the one-row ``max_date`` aggregate, used as a scalar
    subquery: Spark computes it once and the filter compares with a value.
    """
    end = bounds.select("max_date").scalar()
    return df.where((F.col(col) >= F.date_sub(end, days_back)) & (F.col(col) <= end))


def to_numeric(df: DataFrame, ints: Sequence[str] = CHART_INT_COLUMNS,
               floats: Sequence[str] = CHART_FLOAT_COLUMNS) -> DataFrame:
    """``ing_to_numeric``: bad numbers become null; whole-number columns are rounded to 64 bits."""
    cols = {c: to_int(c) for c in ints}
    cols.update({c: to_number(c) for c in floats})
    return df.withColumns(cols)


def project_order(df: DataFrame, columns: Sequence[str] = CHART_COLUMNS) -> DataFrame:
    """``ing_project_order``: fixed column order, names upper-cased."""
    return df.select(*[F.col(c).alias(c.upper()) for c in columns])


def clean_charts(raw: DataFrame, markets: Sequence[str] | None = None,
                 t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The whole chart cleaning: strip, upper, dates, keys, markets, window, numbers, order."""
    bounds = checked_bounds(raw)
    df = parse_dates(upper_country(strip_columns(raw)))
    df = drop_missing_keys(df)
    df = market_filter(df, markets if markets is not None else t.ingest_markets)
    df = date_window(df, bounds, t.ingest_days_back)
    return project_order(to_numeric(df))


def clean_campaigns(raw: DataFrame) -> DataFrame:
    """Campaign cleaning: strip text, upper country, dates, numbers, drop rows missing a key."""
    df = raw.withColumns({c: strip_text(c) for c in CAMPAIGN_TEXT_COLUMNS})
    df = df.withColumn("COUNTRY", F.upper(F.col("COUNTRY")))
    df = df.withColumns({c: parse_date(c) for c in CAMPAIGN_DATE_COLUMNS})
    df = df.withColumns({c: to_number(c) for c in CAMPAIGN_FLOAT_COLUMNS})
    df = df.withColumns({c: to_int(c) for c in CAMPAIGN_LONG_COLUMNS})
    return df.dropna(subset=list(CAMPAIGN_KEYS)).select(*CAMPAIGN_COLUMNS)


def anchors_from_filtered(filtered: DataFrame) -> DataFrame:
    """``src_anchor_csv``: the filtered chart file as campaign anchors.

    Requires six columns (``ValueError`` naming the missing ones), parses the
    two dates, drops rows without a key, upper-cases the country.
    """
    required = ["SPOTIFY_ID", "NAME", "ARTISTS", "COUNTRY", "SNAPSHOT_DATE", "DAILY_MOVEMENT"]
    missing = [c for c in required if c not in filtered.columns]
    if missing:
        raise ValueError("the anchor file lacks: " + ", ".join(missing))
    df = filtered.withColumns({"SNAPSHOT_DATE": parse_date("SNAPSHOT_DATE"),
                               "ALBUM_RELEASE_DATE": parse_date("ALBUM_RELEASE_DATE")})
    df = df.dropna(subset=["SPOTIFY_ID", "COUNTRY", "SNAPSHOT_DATE"])
    return df.withColumn("COUNTRY", upper_code("COUNTRY"))
