"""Distinct counts from merged bitmaps equal COUNT(DISTINCT) for all filters."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from tidemark.operators import distinct as DI
from tidemark.operators import marts as M


def test_bitmaps_equal_count_distinct(spark):
    rng = random.Random(9)
    weeks = [dt.date(2025, 1, 6) + dt.timedelta(7 * i) for i in range(4)]
    rows = [(rng.choice([None, *(f"i{n}" for n in range(300))]), rng.choice([None, "X", "Y", "Z"]), rng.choice(weeks), rng.randint(1, 10)) for _ in range(900)]
    life = spark.createDataFrame(rows, "spotify_id string, country string, chart_week date, cross_market_count long")
    codes = DI.item_codes(life).cache()
    n = len({r[0] for r in rows} - {None})
    assert sorted(r.code for r in codes.collect()) == list(range(1, n + 1))
    # codes far apart: several buckets of 32,768
    codes = codes.withColumn("code", F.col("code") * 1000)
    maps = DI.item_bitmaps(life, codes).cache()
    assert maps.select("bucket").distinct().count() > 5
    for markets in (["X"], ["X", "Z"], ["none"], ["X", "Y", "Z"]):
        for a, b in itertools.combinations_with_replacement(weeks, 2):
            mine = [r for r in rows if r[0] and r[1] in markets and a <= r[2] <= b]
            got = DI.distinct_items(maps.where(F.col("country").isin(markets) & F.col("chart_week").between(F.lit(a), F.lit(b)))).first()
            assert tuple(got) == tuple(len({r[0] for r in mine if r[3] >= k}) for k in (0, 5, 8))
    by = {r.country: r.total_tracks for r in DI.distinct_items(maps, ("country",)).collect()}
    assert by == {m: len({r[0] for r in rows if r[1] == m} - {None}) for m in ("X", "Y", "Z", None)}


def test_rows_without_an_id_count_alike_in_summary_and_mart(spark):
    cols = M.LIFE_COLUMNS
    kinds = {"cross_market_count": "long", "weekly_chart_points": "long", "chart_week": "date", "market_spike_flag": "boolean", "catalog_revival_flag": "boolean",
             "spotify_id": "string", "track_name": "string", "artists": "string", "country": "string", "lifecycle_stage": "string"}
    base = {"country": "X", "chart_week": dt.date(2025, 1, 6), "lifecycle_stage": "Peak", "market_spike_flag": True, "catalog_revival_flag": False}
    rows = [{**base, "spotify_id": i, "cross_market_count": n, "weekly_chart_points": p} for i, n, p in (("a", 9, 5), (None, 9, 50), ("b", 5, None))]
    life = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ", ".join(f"{c} {kinds.get(c, 'double')}" for c in cols))
    summary, mart = M.country_week_summary(life).first().asDict(), M.market_trends(life).first().asDict()
    assert summary == {k: mart[k] for k in summary}
    assert (mart["tracks_tracked"], mart["multi_market_tracks"], mart["cross_market_champions"], mart["peak_tracks"]) == (2, 2, 1, 3)
    assert mart["top_track_chart_points"] == 50 and M.join_top_track(M.country_week_summary(life), life).first().asDict() == mart


def test_text_codes_keep_the_order(spark, tmp_path):
    """MAX of codes is MAX of texts (bytes, not letters, decide), nulls stay null, and nothing is sorted for the aggregate."""
    from tidemark.operators import textcodes as X
    from tidemark.operators import weekly as W
    rng = random.Random(1)
    names = [None, "", "Z", "a", "é", "中", "a b", "A", "zz", "\U0001F600", "￿"]
    kinds = "spotify_id string, track_name string, artists string, daily_rank int, country string, snapshot_date date, popularity int, " \
            "album_name string, album_release_date date, " + ", ".join(f"{f} double" for f in W.FEATURES)
    rows = [(rng.choice("XY"), rng.choice(names), rng.choice(names), rng.randint(1, 200), rng.choice("KL"), dt.date(2025, 1, 1) + dt.timedelta(rng.randint(0, 30)),
             1, rng.choice(names), None, *[1.0] * len(W.FEATURES)) for _ in range(200)]
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "charts"))
    charts = spark.read.parquet(str(tmp_path / "charts"))
    codes = X.text_codes(charts).cache()
    assert [r.text for r in codes.orderBy("code").collect()] == sorted((n for n in names if n is not None), key=lambda t: t.encode())
    X.encode(charts, codes).write.parquet(str(tmp_path / "coded"))
    coded = spark.read.parquet(str(tmp_path / "coded"))
    got, want = X.weekly_from_codes(coded, codes), W.weekly_aggregates(charts)
    assert got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan(want) and "SortAggregate" not in plan(W.weekly_aggregates(coded))
