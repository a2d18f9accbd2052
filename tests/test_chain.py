"""The chain kept up week by week equals the full build on every prefix of weeks."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lifecycle as L
from tidemark.operators import weekly as W
from tidemark.operators.chain import WeeklyChain

NAMES = ("spotify_id", "track_name", "artists", "daily_rank", "country", "snapshot_date", "popularity", "album_name", "album_release_date", *W.FEATURES)
SCHEMA = "spotify_id string, track_name string, artists string, daily_rank int, country string, snapshot_date date, popularity int, " \
         "album_name string, album_release_date date, " + ", ".join(f"{f} double" for f in W.FEATURES)


def charts(spark):
    rng, rows = random.Random(2), []
    monday = dt.date(2024, 1, 1)
    for item in "ABCDEFG":
        for market in "XYZ":
            for week in range(40):
                if rng.random() < 0.35 or (item == "A" and 10 < week < 30):        # gaps, one longer than 90 days
                    continue
                for day in rng.sample(range(7), rng.randint(1, 3)):
                    rows.append((item, f"n{week}", "a", rng.choice([1, 2, 50, 201, 150]), market, monday + dt.timedelta(week * 7 + day), 5, "al",
                                 dt.date(2020, 1, 1), *[float(rng.randint(0, 9))] * len(W.FEATURES)))
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_prefix_equals_the_full_build(spark, tmp_path):
    all_rows = charts(spark).cache()
    chain = WeeklyChain(spark, str(tmp_path / "chain"))
    seen = set()
    for lo, hi in ((0, 1), (1, 2), (2, 11), (11, 12), (12, 31), (31, 40)):
        start, end = (dt.date(2024, 1, 1) + dt.timedelta(7 * n) for n in (lo, hi))
        day = F.col("snapshot_date")
        chain.advance(all_rows.where((day >= F.lit(start)) & (day < F.lit(end))))
        full = L.lifecycle(W.weekly_growth(W.weekly_aggregates(all_rows.where(day < F.lit(end))), keep_history=True))
        got = rows_of(chain.life())
        assert got == rows_of(full), (lo, hi)
        seen |= {r.lifecycle_stage for r in chain.life().select("lifecycle_stage").distinct().collect()}
    assert seen >= {"Debut", "Revived", "Peak", "Growing", "Declining"}
    with pytest.raises(Exception, match="closed"):
        chain.advance(all_rows.where("snapshot_date >= '2024-10-01'"))
    assert rows_of(chain.life()) == got                 # the failed load left the chain as it was
    assert chain.advance(all_rows.limit(0)) == 0 and rows_of(chain.life()) == got


def test_advance_reads_new_rows_and_the_state_only(spark, tmp_path):
    all_rows = charts(spark).cache()
    chain = WeeklyChain(spark, str(tmp_path / "chain"))
    chain.advance(all_rows.where("snapshot_date < '2024-06-03'"))
    parts = tmp_path / "chain" / "part"
    os.rename(parts, tmp_path / "away")                 # history out of reach
    chain.advance(all_rows.where("snapshot_date >= '2024-06-03'"))
    for name in os.listdir(tmp_path / "away"):
        os.rename(tmp_path / "away" / name, parts / name)
    full = L.lifecycle(W.weekly_growth(W.weekly_aggregates(all_rows), keep_history=True))
    assert rows_of(chain.life()) == rows_of(full)


def test_a_chain_without_weeks(spark, tmp_path):
    chain = WeeklyChain(spark, str(tmp_path / "chain"))
    assert chain.last_week is None and chain.state() is None
    with pytest.raises(ValueError, match="no week"):
        chain.life()
