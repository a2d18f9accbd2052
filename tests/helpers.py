"""Builders for small hand-made frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from tidemark.operators.weekly import WEEKLY_COLUMNS

_TYPES = {
    "spotify_id": T.StringType(), "track_name": T.StringType(), "artists": T.StringType(),
    "country": T.StringType(), "chart_week": T.DateType(), "weekly_chart_points": T.LongType(),
    "avg_daily_chart_points": T.DoubleType(), "avg_daily_rank": T.DoubleType(), "best_daily_rank": T.IntegerType(),
    "chart_days": T.LongType(), "avg_popularity": T.DoubleType(), "first_chart_date_in_week": T.DateType(),
    "last_chart_date_in_week": T.DateType(), "album_name": T.StringType(), "album_release_date": T.DateType(),
}


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def weekly_frame(spark, rows):
    """rows: (item, market, week 'YYYY-MM-DD', points) -> a weekly_aggregates-shaped frame."""
    schema = T.StructType([T.StructField(c, _TYPES.get(c, T.DoubleType()), True) for c in WEEKLY_COLUMNS])
    data = []
    for item, market, week, pts in rows:
        w = d(week)
        rec = {c: None for c in WEEKLY_COLUMNS}
        rec.update(spotify_id=item, track_name=f"name {item}", artists="artist", country=market, chart_week=w,
                   weekly_chart_points=pts, chart_days=7, first_chart_date_in_week=w, last_chart_date_in_week=w,
                   album_release_date=d("2020-01-01"))
        data.append(tuple(rec[c] for c in WEEKLY_COLUMNS))
    return spark.createDataFrame(data, schema)
