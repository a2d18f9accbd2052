"""What keeps the queries' cost in step with large order tables."""

import contextlib
import glob
import io
import os
import re
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from helpers import d, weekly_frame
from test_campaigns import CAMP_SCHEMA
from tidemark.functions.text import parse_date, strip_text
from tidemark.operators import campaigns as C
from tidemark.operators import ingest as I
from tidemark.operators import lifecycle as L
from tidemark.operators import weekly as W
from tidemark.plans import registry
from tidemark.session import SHUFFLE_CLEANUP, shuffles_removed
from tidemark.sources import binding
from tidemark.sources import files as FS
from tidemark.sources import versions as V


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _built(spark, sf, name) -> bool:
    return V.current(spark, FS.io_path(spark, sf, name)) is not None


def _life(spark):
    rows = [("A", m, w, p + i) for i, m in enumerate(("NL", "BE", "DE")) for w, p in (("2025-01-06", 100), ("2025-01-13", 130))]
    return L.lifecycle(W.weekly_growth(weekly_frame(spark, rows), keep_history=True))


def _campaigns(spark, ids):
    markets = ("NL", "BE", "DE", "FR", None)
    rows = [(x, "A" if i % 7 else "B", "t", "a", markets[i % 5], d("2025-01-14"), None, None, f"ch{i % 2}", 10.0 + i, 0, 0, 0.0, 0.0, 100 + i, "random_timing")
            for i, x in enumerate(ids)]
    return spark.createDataFrame(rows, CAMP_SCHEMA)


def test_a_query_loads_only_the_raw_tables_it_needs(spark, tmp_path):
    sf = str(tmp_path / "one")
    os.symlink(SF001, sf)
    registry.queries()["cost_per_stream"](spark, sf)
    assert _built(spark, sf, "raw_campaigns") and not _built(spark, sf, "raw_charts")
    sf = str(tmp_path / "two")
    os.symlink(SF001, sf)
    for name in ("win_prev_week", "mart_market_trends"):
        registry.queries()[name](spark, sf)
    assert _built(spark, sf, "raw_charts") and not _built(spark, sf, "raw_campaigns")


def _tables(spark, folder):
    """Two orders of one day whose parts differ in type and name, one part without them, one without lines."""
    day = "TIMESTAMP '1996-01-02 00:00:00'"
    made = {
        "nation": "SELECT 1 AS n_nationkey, 'FRANCE' AS n_name",
        "customer": "SELECT 1L AS c_custkey, 1 AS c_nationkey",
        "orders": f"SELECT id AS o_orderkey, 1L AS o_custkey, {day} AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(1, 3)",
        "part": "SELECT * FROM VALUES (1L, 'b', 'Brand#1', 'Z', 5), (2L, 'a', 'Brand#1', 'é', 7), (3L, null, 'Brand#1', null, 1), (4L, 'zz', 'Brand#1', 'zz', 9), "
                "(5L, null, 'Brand#2', null, 2) AS t(p_partkey, p_name, p_brand, p_type, p_size)",
        "lineitem": f"SELECT o AS l_orderkey, p AS l_partkey, n AS l_linenumber, 10D AS l_quantity, 1.25D AS l_extendedprice, 0.06D AS l_discount, 0.01D AS l_tax, {day} AS l_shipdate "
                    "FROM VALUES (1L, 1L, 1), (1L, 1L, 2), (1L, 1L, 3), (1L, 2L, 4), (2L, 3L, 1), (2L, 5L, 2), (null, 1L, 1), (1L, null, 9) AS t(o, p, n)",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")


def _weeks_of_tables(spark, folder):
    """Four markets (two of one name, one without), four parts (one without a brand), lines over five weeks; keys that repeat, lines without order or part."""
    made = {
        "nation": "SELECT * FROM VALUES (1, 'FRANCE'), (2, 'PERU'), (3, 'PERU'), (4, null) AS t(n_nationkey, n_name)",
        "customer": "SELECT id AS c_custkey, CAST(id % 5 AS INT) AS c_nationkey FROM range(1, 11)",
        "orders": "SELECT id AS o_orderkey, id % 11 AS o_custkey, TIMESTAMP '1996-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(1, 121)",
        "part": "SELECT * FROM VALUES (1L, 'b', 'Brand#1', 'Z', 5), (2L, 'a', 'Brand#1', null, 7), (3L, null, 'Brand#2', 'x', 1), (4L, 'c', null, 'y', 2) "
                "AS t(p_partkey, p_name, p_brand, p_type, p_size)",
        "lineitem": "SELECT IF(id % 37 = 0, null, id % 120 + 1) AS l_orderkey, IF(id % 41 = 0, null, id % 4 + 1) AS l_partkey, CAST(id % 7 AS INT) AS l_linenumber, "
                    "CAST(id % 50 AS DOUBLE) AS l_quantity, (id * 7919 % 10007) / 100D AS l_extendedprice, 0.06D AS l_discount, 0.01D AS l_tax, "
                    "CAST(IF(id % 43 = 0, null, date_add(DATE '1996-01-01', CAST(id * 13 % 35 AS INT))) AS TIMESTAMP) AS l_shipdate FROM range(900)",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")


def test_join_control_writes_only_growth_rates(spark, tmp_path):
    """No wide table is written for it, and its rows are those of the written tables."""
    _weeks_of_tables(spark, tmp_path)
    sf = str(tmp_path)
    df = registry.queries()["join_control"](spark, sf)
    assert not any(_built(spark, sf, x) for x in ("raw_campaigns", "raw_charts", "life")) and _built(spark, sf, "growth_rates")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scans = re.findall(r"ReadSchema: struct<([^>]*)>", registry.queries()["join_control"](spark, sf)._jdf.queryExecution().executedPlan().treeString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp" in scans
    assert "round(" not in _plan(df).split("Join")[0]                # rates are rounded before they meet the campaigns
    got = sorted(map(str, df.collect()))
    t = registry.tables(spark, sf)
    assert sorted(map(str, registry.finalize(C.join_control(t.campaigns, t.life)).collect())) == got and len(got) > 20
    # now that the tables are there, they are read
    folders = {t.campaigns.inputFiles()[0].rsplit("/", 1)[0], t.life.inputFiles()[0].rsplit("/", 1)[0]}
    df = registry.queries()["join_control"](spark, sf)
    assert {x.rsplit("/", 1)[0] for x in df.inputFiles()} == folders
    assert sorted(map(str, df.collect())) == got


def test_growth_rates_are_those_of_the_lifecycle_table(spark, tmp_path):
    _weeks_of_tables(spark, tmp_path)
    t = registry.tables(spark, str(tmp_path))
    narrow = t.growth_rates
    assert not _built(spark, str(tmp_path), "life") and narrow.columns == list(L.RATE_COLUMNS)
    rows = sorted(map(str, narrow.collect()))
    assert rows == sorted(map(str, t.life.select(*L.RATE_COLUMNS).collect())) and len(rows) > 10


def test_some_chart_columns_are_those_of_all(spark, tmp_path):
    _weeks_of_tables(spark, tmp_path)
    whole = binding.chart_rows(spark, str(tmp_path))
    for some in (W.RATE_CHART_COLUMNS, ("album_name", "spotify_id", "daily_movement", "tempo", "mode"), whole.columns):
        got = binding.chart_rows(spark, str(tmp_path), some)
        assert got.columns == list(some) and got.dtypes == whole.select(*some).dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(*some).collect()))


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    held = lambda: {f for d in env.blockManager().diskBlockManager().localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}
    before = held()
    V.replace(spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).count(), str(tmp_path / "t"))
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.1)
    assert not held() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        with shuffles_removed(spark), shuffles_removed(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def test_chart_texts_are_the_greatest_of_the_group(spark, tmp_path):
    _tables(spark, tmp_path)
    rows = {r.spotify_id: r for r in binding.chart_rows(spark, str(tmp_path)).collect()}
    one, two = rows["Brand#1"], rows["Brand#2"]
    assert (one.artists, one.album_name, one.danceability, one.energy, one.popularity, one.daily_rank) == ("é", "b", 5.0, 50.0, 7, 1)
    assert (two.artists, two.album_name, two.danceability) == (None, None, 1.0)


def test_chart_lines_are_not_sorted_for_their_texts(spark, monkeypatch):
    seen = []
    ranked = binding.group_row_number
    monkeypatch.setattr(binding, "group_row_number", lambda df, *a, **k: seen.append(_plan(df)) or ranked(df, *a, **k))
    binding.chart_rows(spark, SF001)
    assert "HashAggregate" in seen[-1] and "SortAggregate" not in seen[-1]


def test_campaign_rows_of_repeated_lines(spark, tmp_path):
    _tables(spark, tmp_path)
    df = binding.campaign_rows(spark, str(tmp_path))
    assert _plan(df).count("hashpartitioning(l_orderkey") == 1
    assert sorted((r.campaign_id, r.generation_type, r.spend_eur) for r in df.collect()) == [
        ("CMP_1_1", "movement_anchored", 0.0375), ("CMP_1_2", "random_timing", 0.0125), ("CMP_2_3", "random_timing", 0.0125), ("CMP_2_5", "random_timing", 0.0125)]


def test_campaign_rows_stay_in_place_for_look_ups(spark, monkeypatch):
    """Small look-ups leave the campaigns where they are; above the limit the shuffle join gives the same rows."""
    life, camps = _life(spark), _campaigns(spark, [f"C{i}" for i in range(40)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    forms = {"market": lambda: C.join_campaign_market(camps, life), "control": lambda: C.join_control(camps, life),
             "both": lambda: C.campaign_market_and_control(camps, life), "mart": lambda: C.campaign_performance(camps, life)}
    try:
        got = {}
        for rows in (C.LOOKUP_ROWS, 0):
            monkeypatch.setattr(C, "LOOKUP_ROWS", rows)
            for name, form in forms.items():
                df = form()
                assert ("SortMergeJoin" not in _plan(df)) == (rows > 0), name
                got[name, rows] = sorted(map(str, df.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(got[name, 0] == got[name, 500_000] and got[name, 0] for name in forms)


def test_control_average_of_repeated_and_missing_ids(spark, monkeypatch):
    """As the plain form has it: averages by id, joined back."""
    life = _life(spark)
    ids = [f"C{i}" for i in range(20)] + ["SAME"] * 9 + [None] * 4 + ["TWICE", "TWICE"]
    camps = _campaigns(spark, ids)
    plain = C.join_campaign_market(camps, life).join(C.control_market_growth(camps, life), "campaign_id", "left") \
        .withColumn("lift_vs_control", F.expr("campaign_market_wow_growth - control_market_avg_wow_growth"))
    for rows in (C.LOOKUP_ROWS, 0):
        monkeypatch.setattr(C, "LOOKUP_ROWS", rows)
        got = C.join_control_back(camps, life)
        assert got.columns == plain.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    # no wide row crosses a shuffle
    monkeypatch.setattr(C, "LOOKUP_ROWS", 500_000)
    assert "SortMergeJoin" not in _plan(C.join_control_back(camps, life))


def test_strip_is_that_of_the_unicode_pattern(spark):
    points = [chr(i) for i in range(0x3100)]
    df = spark.createDataFrame([(x,) for c in points for x in (c, f"{c}a b{c}", f" {c} x \n{c}")], "v string")
    pattern = F.regexp_replace("v", r"(?U)^\s+|\s+$", "")
    assert df.where(~strip_text("v").eqNullSafe(pattern)).count() == 0


def test_dates_are_those_of_the_formatter(spark):
    texts = ["2024-01-01", " 2024-02-29\t", "2023-02-29", "0000-01-01", "0001-01-01", "9999-12-31", "12345-01-01", "+12345-01-01", "-2024-01-01", "2024-1-1", "1999",
             "1999-01", "2024-01-01T00:00", "2024-13-01", "2024-00-10", "1582-10-10", "1900-02-29", "", None, "not a date", "2024/01/01", "２０２４-01-01"]
    df = spark.createDataFrame([(x,) for x in texts], "v string")
    slow = F.try_to_timestamp(strip_text("v"), F.lit("yyyy-MM-dd")).cast("date")
    assert [r for r in df.select("v", parse_date("v").cast("string"), slow.cast("string")).collect() if r[1] != r[2]] == []


def test_cleaning_compiles(spark, tmp_path):
    """The JVM runs methods above 8000 bytes uncompiled; the cleaning of a row is one method."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")          # the whole plan is shown
    try:
        path = str(tmp_path / "raw.csv")
        for columns, clean in ((I.CAMPAIGN_COLUMNS, I.clean_campaigns), (I.CHART_COLUMNS, lambda df: I.clean_charts(df, ["NL"]))):
            with open(path, "w") as out:
                out.write(",".join(columns) + "\n" + ",".join("2024-01-01" for _ in columns) + "\n")
            schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
            shown = io.StringIO()
            with contextlib.redirect_stdout(shown):
                clean(spark.read.schema(schema).option("header", True).csv(path)).explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
            assert sizes and max(sizes) < 8000, (columns[0], sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
