"""Every registered query: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where SQL can say it, the DuckDB oracle text.

All queries run over the whole driver tables.  DOUBLE outputs are rounded to
9 places on both sides (see ``finalize`` and ``oracle.round_doubles``); the
rounded column lists live in ``doubles.json`` (regenerated by
``python -m tidemark.plans.registry``) and a test keeps them in step with
the Spark schemas.
"""

from __future__ import annotations

import hashlib
import json
import os
from contextvars import ContextVar
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import week_of
from tidemark.operators import campaigns as C
from tidemark.operators import construction as K
from tidemark.operators import dashboard as D
from tidemark.operators import distinct as DI
from tidemark.operators import ingest as I
from tidemark.operators import lifecycle as L
from tidemark.operators import marts as M
from tidemark.operators import quality as Q
from tidemark.operators import staging as S
from tidemark.operators import textcodes as X
from tidemark.operators import weekly as W
from tidemark.operators.chain import WeeklyChain
from tidemark.params import LIFECYCLE_STAGES, DashboardFilter
from tidemark.plans import oracle as O
from tidemark.plans.models import Models
from tidemark.sources import binding
from tidemark.sources import files as FS
from tidemark.sources import versions as V
from tidemark.sources.tables import read_table, table_path

ROUND_DIGITS = 9
KEYS3 = ["spotify_id", "country", "chart_week"]

# Dashboard selection used by the filter queries: some markets, a date range.
PICKED = tuple(f"NATION_{i}" for i in (1, 3, 5, 7, 9, 20))
RANGE_FILTER = DashboardFilter(countries=PICKED, start="1996-01-01", end="1999-12-31")
ALL = DashboardFilter()


def finalize(df: DataFrame) -> DataFrame:
    """Round every DOUBLE column to 9 places (the oracle does the same)."""
    return df.select(*[F.round(F.col(f.name), ROUND_DIGITS).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    rounded: bool = False        # ``build`` has rounded the DOUBLE columns where fewer rows hold them


REG: dict[str, Query] = {}


def q(name: str, sql: str | None = None, rounded: bool = False):
    def deco(fn):
        REG[name] = Query(fn, sql, rounded)
        return fn
    return deco


def _m(spark, sf) -> Models:
    """The models over the loaded raw tables (as the reference's models are
    views over its raw warehouse tables); a raw table is loaded when a model first needs it."""
    t = tables(spark, sf)
    return Models(spark, sf, charts=lambda: t.charts, campaigns=lambda: t.campaigns)


# ----------------------------------------------------------------------------
# Raw tables and files derived from the binding
# ----------------------------------------------------------------------------
RAW_CHART_NAMES = dict(zip(
    ("spotify_id", "track_name", "artists", "daily_rank", "daily_movement", "weekly_movement", "country",
     "snapshot_date", "popularity", "is_explicit", "duration_ms", "album_name", "album_release_date",
     "danceability", "energy", "musical_key", "loudness", "mode", "speechiness", "acousticness",
     "instrumentalness", "liveness", "valence", "tempo", "time_signature"),
    I.CHART_COLUMNS))
RAW_CAMPAIGN_NAMES = dict(zip(C.CAMPAIGN_COLUMNS, I.CAMPAIGN_COLUMNS))

_SQL_RAW_CSV = ", ".join(f"CAST({src} AS VARCHAR) AS {dst}" for src, dst in RAW_CHART_NAMES.items())
_SQL_RAW_CAMP = ", ".join(f"CAST({src} AS VARCHAR) AS {dst}" for src, dst in RAW_CAMPAIGN_NAMES.items())

SOURCES = ("nation", "customer", "part", "orders", "lineitem")
#: What a query saw when it first looked at its input files, so that all its tables agree.
_look: ContextVar[dict[str, str] | None] = ContextVar("look", default=None)
_epoch = 0
_frames: dict[tuple, DataFrame] = {}     # scans of written versions


def _app(spark) -> str:
    """A session's application id (unique per Spark application)."""
    return spark.sparkContext.applicationId


def inputs_of(spark, sf) -> str:
    """What a written table of this application is made from: names, sizes and times of the input files."""
    seen, key = _look.get(), os.path.abspath(sf)
    if seen is not None and key in seen:
        return seen[key]
    found = f"{_app(spark)}:{_epoch}:" + V.fingerprint(spark, [table_path(sf, t) for t in SOURCES])
    if seen is not None:
        seen[key] = found
    return found


def refresh() -> None:
    """Build every written table anew when it is next asked for, even if its input files look the same."""
    global _epoch
    _epoch += 1


def written(spark, sf, name, make: Callable[[], DataFrame], partition_by=(), write=V.write_parquet) -> V.Version:
    """The table ``name`` made from the present input files at ``sf``: kept while they are the same."""
    return V.table(spark, FS.io_path(spark, sf, name), inputs_of(spark, sf), make, partition_by, write)


def scan(spark, sf, name, make: Callable[[], DataFrame], partition_by=()) -> DataFrame:
    v = written(spark, sf, name, make, partition_by)
    key = (_app(spark), v.folder)
    if key not in _frames:
        _frames[key] = v.read(spark)
    return _frames[key]


class Tables:
    """The written tables of one binding: raw tables, lifecycle table and marts, as the reference
    materialises raw tables and marts and its dashboard and tests query them.

    Each is built when first asked for and again after its input files changed; it lies in the
    shared checkpoint folder.
    """

    def __init__(self, spark, sf):
        self.spark, self.sf = spark, sf

    def _scan(self, name, make, partition_by=()) -> DataFrame:
        return scan(self.spark, self.sf, name, make, partition_by)

    @property
    def charts(self) -> DataFrame:
        return self._scan("raw_charts", lambda: binding.chart_rows(self.spark, self.sf))

    @property
    def campaigns(self) -> DataFrame:
        return self._scan("raw_campaigns", lambda: binding.campaign_rows(self.spark, self.sf))

    @property
    def life(self) -> DataFrame:
        return self._scan("life", lambda: Models(self.spark, self.sf, charts=self.charts).life)

    def _columns(self, name: str, columns, make: Callable[[], DataFrame]) -> DataFrame:
        """``columns`` of the table ``name`` if it is written; else the same rows from ``make``, without the table."""
        now = V.current(self.spark, FS.io_path(self.spark, self.sf, name))
        if now is None or now.inputs != inputs_of(self.spark, self.sf):
            return make().select(*columns)
        return self._scan(name, make).select(*columns)

    @property
    def growth_rates(self) -> DataFrame:
        """Key and growth rate of the lifecycle rows.

        Of the lifecycle table if it is there.  Else a table of these columns, for which lines cross
        the shuffles with the few numbers that a rank is made of.
        """
        rank = W.RATE_CHART_COLUMNS
        charts = lambda: self._columns("raw_charts", rank, lambda: binding.chart_rows(self.spark, self.sf, rank))
        make = lambda: self._scan("growth_rates", lambda: Models(self.spark, self.sf, charts=charts).growth_rates)
        return self._columns("life", L.RATE_COLUMNS, make)

    @property
    def campaign_keys(self) -> DataFrame:
        """What ``join_control`` reads of the campaigns: of the raw table if it is there, else of the lines as they are read.

        The table has four times the columns, and all of them would cross the shuffles and be written.
        """
        return self._columns("raw_campaigns", C.CONTROL_COLUMNS, lambda: binding.campaign_rows(self.spark, self.sf))

    @property
    def rep(self) -> DataFrame:
        """Partitioned by ``chart_week``: a dashboard date range prunes partitions."""
        return self._scan("rep", lambda: M.repertoire(self.life), ["chart_week"]).select(*M.REP_COLUMNS)

    @property
    def mkt(self) -> DataFrame:
        """At most markets x weeks rows at any data size: unpartitioned."""
        return self._scan("mkt", lambda: M.market_trends(self.life))

    @property
    def camp(self) -> DataFrame:
        return self._scan("camp", lambda: C.campaign_performance(self.campaigns, self.life))

    @property
    def text_codes(self) -> DataFrame:
        return self._scan("text_codes", lambda: X.text_codes(self.charts))

    @property
    def coded_charts(self) -> DataFrame:
        return self._scan("coded_charts", lambda: X.encode(self.charts, self.text_codes))

    @property
    def item_codes(self) -> DataFrame:
        return self._scan("item_codes", lambda: DI.item_codes(self.life))

    @property
    def item_bitmaps(self) -> DataFrame:
        return self._scan("item_bitmaps", lambda: DI.item_bitmaps(self.life, self.item_codes))

    @property
    def models(self) -> Models:
        return Models(self.spark, self.sf, charts=lambda: self.charts, campaigns=lambda: self.campaigns, life=self.life)


def tables(spark, sf) -> Tables:
    return Tables(spark, sf)


def _raw_chart_text(spark, sf) -> DataFrame:
    return binding.soiled_charts(FS.as_text(tables(spark, sf).charts, RAW_CHART_NAMES))


def _raw_chart_path(spark, sf) -> str:
    return written(spark, sf, "raw_charts_csv", lambda: _raw_chart_text(spark, sf), write=V.write_csv).folder


def raw_chart_csv(spark, sf) -> DataFrame:
    """The chart rows written as a raw CSV (reference column names) and read back."""
    return FS.read_csv(spark, _raw_chart_path(spark, sf), I.CHART_COLUMNS)


def raw_campaign_text(spark, sf) -> DataFrame:
    return binding.soiled_campaigns(FS.as_text(tables(spark, sf).campaigns, RAW_CAMPAIGN_NAMES))


def raw_campaign_csv(spark, sf) -> DataFrame:
    path = written(spark, sf, "raw_campaigns_csv", lambda: raw_campaign_text(spark, sf), write=V.write_csv).folder
    return FS.read_csv(spark, path, I.CAMPAIGN_COLUMNS)


def raw_chart_table(spark, sf) -> DataFrame:
    """The raw chart table as loaded (upper-case names, text values)."""
    return _raw_chart_text(spark, sf).select(*[F.col(c).alias(c.upper()) for c in RAW_CHART_NAMES.values()])


def markets(spark, sf) -> DataFrame:
    return read_table(spark, sf, "nation", ["n_name"])


def ingested(spark, sf) -> DataFrame:
    return I.clean_charts(raw_chart_csv(spark, sf), markets(spark, sf))


O.CTES["raw_csv"] = f"""
  SELECT * EXCLUDE (k) REPLACE (
    CASE k WHEN 1 THEN NULL WHEN 2 THEN '  ' || spotify_id || ' ' ELSE spotify_id END AS spotify_id,
    CASE k WHEN 3 THEN chr(9) || name || ' ' ELSE name END AS name,
    CASE k WHEN 4 THEN ' ' || lower(country) WHEN 5 THEN 'ATLANTIS' ELSE country END AS country,
    CASE k WHEN 6 THEN 'not a date' WHEN 7 THEN NULL ELSE snapshot_date END AS snapshot_date,
    CASE k WHEN 8 THEN '1999' ELSE album_release_date END AS album_release_date,
    CASE k WHEN 9 THEN daily_rank || '.7' WHEN 10 THEN 'n/a' ELSE daily_rank END AS daily_rank,
    CASE k WHEN 11 THEN '3000000000' ELSE duration_ms END AS duration_ms)
  FROM (SELECT {_SQL_RAW_CSV}, (dayofyear(charts.snapshot_date) * 31 + charts.daily_rank * 7) % 97 AS k FROM charts) x"""
O.CTES["raw_table"] = "\n  SELECT " + ", ".join(f"{c} AS {c.upper()}" for c in RAW_CHART_NAMES.values()) + " FROM raw_csv"
O.CTES["raw_camp"] = f"""
  SELECT * EXCLUDE (k) REPLACE (
    CASE k WHEN 1 THEN NULL WHEN 2 THEN 'CMP_SAME' ELSE CAMPAIGN_ID END AS CAMPAIGN_ID,
    CASE k WHEN 3 THEN ' ' || lower(COUNTRY) ELSE COUNTRY END AS COUNTRY,
    CASE k WHEN 4 THEN 'not a date' ELSE SNAPSHOT_DATE END AS SNAPSHOT_DATE,
    CASE k WHEN 5 THEN '3000000000' ELSE IMPRESSIONS END AS IMPRESSIONS,
    CASE k WHEN 6 THEN ATTRIBUTED_STREAMS || '.5' ELSE ATTRIBUTED_STREAMS END AS ATTRIBUTED_STREAMS,
    CASE k WHEN 7 THEN 'free' ELSE SPEND_EUR END AS SPEND_EUR)
  FROM (SELECT {_SQL_RAW_CAMP}, (campaigns.clicks // 2) % 97 AS k FROM campaigns) x"""
_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
O.CTES["ing_clean"] = "\n  SELECT " + ", ".join(
    (f"upper({_STRIP.format(c=c)}) AS {c}" if c == "country" else
     f"{_STRIP.format(c=c)} AS {c}" if c in I.CHART_TEXT_COLUMNS else
     f"CAST(TRY_STRPTIME({_STRIP.format(c=c)}, '%Y-%m-%d') AS DATE) AS {c}"
     if c in ("snapshot_date", "album_release_date") else c)
    for c in I.CHART_COLUMNS) + " FROM raw_csv"
O.CTES["ing_kept"] = """
  SELECT * FROM ing_clean WHERE spotify_id IS NOT NULL AND country IS NOT NULL AND snapshot_date IS NOT NULL"""
O.CTES["ing_market"] = "\n  SELECT * FROM ing_kept WHERE country IN (SELECT n_name FROM nation)"
O.CTES["ing_bounds"] = "\n  SELECT MAX(snapshot_date) AS max_date FROM ing_clean"
O.CTES["ing_window"] = """
  SELECT * FROM ing_market
  WHERE snapshot_date >= (SELECT max_date FROM ing_bounds) - 90
    AND snapshot_date <= (SELECT max_date FROM ing_bounds)"""


def whole(c: str) -> str:
    """Text -> BIGINT, a fraction rounded half away from zero."""
    return f"TRY_CAST(ROUND(TRY_CAST({c} AS DECIMAL(38,6))) AS BIGINT)"


def _num_sql(c):
    if c in I.CHART_INT_COLUMNS:
        return f"{whole(_STRIP.format(c=c))} AS {c}"
    if c in I.CHART_FLOAT_COLUMNS:
        return f"TRY_CAST({_STRIP.format(c=c)} AS DOUBLE) AS {c}"
    return c


O.CTES["ing_numeric"] = "\n  SELECT " + ", ".join(_num_sql(c) for c in I.CHART_COLUMNS) + " FROM ing_window"
O.CTES["ing_out"] = "\n  SELECT " + ", ".join(f"{c} AS {c.upper()}" for c in I.CHART_COLUMNS) + " FROM ing_numeric"


def _stg_chart_sql(src: str) -> str:
    i = whole
    dt = lambda c: f"CAST(TRY_STRPTIME(CAST({c} AS VARCHAR), '%Y-%m-%d') AS DATE)"
    dbl = lambda c: f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
    return f"""
  SELECT TRIM(SPOTIFY_ID, ' ') AS spotify_id, TRIM(NAME, ' ') AS track_name, TRIM(ARTISTS, ' ') AS artists,
         {i('DAILY_RANK')} AS daily_rank, {i('DAILY_MOVEMENT')} AS daily_movement,
         {i('WEEKLY_MOVEMENT')} AS weekly_movement, UPPER(TRIM(COUNTRY, ' ')) AS country,
         {dt('SNAPSHOT_DATE')} AS snapshot_date, {i('POPULARITY')} AS popularity,
         TRY_CAST(CAST(IS_EXPLICIT AS VARCHAR) AS BOOLEAN) AS is_explicit, {i('DURATION_MS')} AS duration_ms,
         TRIM(ALBUM_NAME, ' ') AS album_name, {dt('ALBUM_RELEASE_DATE')} AS album_release_date,
         {dbl('DANCEABILITY')} AS danceability, {dbl('ENERGY')} AS energy, {i('"KEY"')} AS musical_key,
         {dbl('LOUDNESS')} AS loudness, {i('MODE')} AS mode, {dbl('SPEECHINESS')} AS speechiness,
         {dbl('ACOUSTICNESS')} AS acousticness, {dbl('INSTRUMENTALNESS')} AS instrumentalness,
         {dbl('LIVENESS')} AS liveness, {dbl('VALENCE')} AS valence, {dbl('TEMPO')} AS tempo,
         {i('TIME_SIGNATURE')} AS time_signature
  FROM {src}
  WHERE SPOTIFY_ID IS NOT NULL AND COUNTRY IS NOT NULL AND SNAPSHOT_DATE IS NOT NULL"""


O.CTES["stg_c"] = _stg_chart_sql("raw_table")

O.CTES["stg_camp"] = f"""
  SELECT TRIM(CAMPAIGN_ID, ' ') AS campaign_id, TRIM(SPOTIFY_ID, ' ') AS spotify_id,
         TRIM(TRACK_NAME, ' ') AS track_name, TRIM(ARTISTS, ' ') AS artists, UPPER(TRIM(COUNTRY, ' ')) AS country,
         CAST(TRY_STRPTIME(SNAPSHOT_DATE, '%Y-%m-%d') AS DATE) AS snapshot_date,
         CAST(TRY_STRPTIME(CAMPAIGN_START_DATE, '%Y-%m-%d') AS DATE) AS campaign_start_date,
         CAST(TRY_STRPTIME(CAMPAIGN_END_DATE, '%Y-%m-%d') AS DATE) AS campaign_end_date,
         TRIM(CHANNEL, ' ') AS channel, TRY_CAST(SPEND_EUR AS DOUBLE) AS spend_eur,
         {whole('IMPRESSIONS')} AS impressions,
         {whole('CLICKS')} AS clicks, TRY_CAST(CTR AS DOUBLE) AS ctr,
         TRY_CAST(CONVERSION_RATE AS DOUBLE) AS conversion_rate,
         {whole('ATTRIBUTED_STREAMS')} AS attributed_streams,
         TRIM(GENERATION_TYPE, ' ') AS generation_type
  FROM raw_camp
  WHERE CAMPAIGN_ID IS NOT NULL AND SPOTIFY_ID IS NOT NULL AND COUNTRY IS NOT NULL AND SNAPSHOT_DATE IS NOT NULL"""


# ----------------------------------------------------------------------------
# 2.1 Scans, sources, sinks
# ----------------------------------------------------------------------------
@q("src_table_ref", "SELECT * FROM charts")
def src_table_ref(spark, sf):
    return tables(spark, sf).charts


@q("src_chart_csv", "SELECT * FROM raw_csv")
def src_chart_csv(spark, sf):
    return raw_chart_csv(spark, sf)


@q("src_chart_csv_quoted", f"""SELECT * EXCLUDE (k) REPLACE (
    CASE k WHEN 0 THEN name || chr(10) || '"live", part ' || daily_rank WHEN 1 THEN chr(10) || name ELSE name END AS name)
  FROM (SELECT {_SQL_RAW_CSV}, (dayofyear(charts.snapshot_date) + charts.daily_rank) % 3 AS k FROM charts) x""")
def src_chart_csv_quoted(spark, sf):
    """Chart rows whose names hold quotes, commas and line breaks, written as CSV and read back in parallel."""
    def broken():
        raw = FS.as_text(tables(spark, sf).charts, RAW_CHART_NAMES)
        k = (F.dayofyear(F.col("snapshot_date").cast("date")) + F.col("daily_rank").cast("int")) % 3
        name = F.when(k == 0, F.concat("name", F.lit('\n"live", part '), "daily_rank")).when(k == 1, F.concat(F.lit("\n"), "name")).otherwise(F.col("name"))
        return raw.withColumn("name", name)
    path = written(spark, sf, "raw_charts_quoted_csv", broken, write=V.write_csv).folder
    return FS.read_csv(spark, path, I.CHART_COLUMNS, multiline=True)


@q("src_campaign_csv", "SELECT * FROM raw_camp")
def src_campaign_csv(spark, sf):
    return raw_campaign_csv(spark, sf)


@q("sink_filtered_csv", "SELECT " + ", ".join(f"CAST({c.upper()} AS VARCHAR) AS {c.upper()}"
                                              for c in I.CHART_COLUMNS) + " FROM ing_out")
def sink_filtered_csv(spark, sf):
    path = written(spark, sf, "filtered_charts_csv", lambda: ingested(spark, sf), write=V.write_csv).folder
    return FS.read_csv(spark, path, [c.upper() for c in I.CHART_COLUMNS])


@q("src_anchor_csv", "SELECT " + ", ".join(
    (f"CAST({c.upper()} AS DATE) AS {c.upper()}" if c in ("snapshot_date", "album_release_date")
     else f"CAST({c.upper()} AS VARCHAR) AS {c.upper()}") for c in I.CHART_COLUMNS) + " FROM ing_out")
def src_anchor_csv(spark, sf):
    return I.anchors_from_filtered(sink_filtered_csv(spark, sf))


@q("sink_raw_table", "SELECT * FROM ing_out")
def sink_raw_table(spark, sf):
    return scan(spark, sf, "raw_chart_table", lambda: ingested(spark, sf))


@q("sink_mart", "SELECT * FROM rep")
def sink_mart(spark, sf):
    """The repertoire mart as written (a table partitioned by ``chart_week``), read back."""
    return tables(spark, sf).rep


# ----------------------------------------------------------------------------
# 2.2 Ingestion cleaning
# ----------------------------------------------------------------------------
@q("ing_max_date", "SELECT max_date FROM ing_bounds")
def ing_max_date(spark, sf):
    return I.max_date(raw_chart_csv(spark, sf))


@q("ing_strip_text", "SELECT " + ", ".join(f"{_STRIP.format(c=c)} AS {c}" for c in I.CHART_TEXT_COLUMNS)
   + " FROM raw_csv")
def ing_strip_text(spark, sf):
    return I.strip_columns(raw_chart_csv(spark, sf)).select(*I.CHART_TEXT_COLUMNS)


@q("ing_upper_country", "SELECT spotify_id, snapshot_date, upper(" + _STRIP.format(c="country")
   + ") AS country FROM raw_csv")
def ing_upper_country(spark, sf):
    return I.upper_country(raw_chart_csv(spark, sf)).select("spotify_id", "snapshot_date", "country")


@q("ing_parse_dates", "SELECT spotify_id, country, snapshot_date, album_release_date FROM ing_clean")
def ing_parse_dates(spark, sf):
    raw = I.strip_columns(raw_chart_csv(spark, sf))
    return I.parse_dates(I.upper_country(raw)).select("spotify_id", "country", "snapshot_date",
                                                      "album_release_date")


@q("ing_drop_missing_keys", "SELECT * FROM ing_kept")
def ing_drop_missing_keys(spark, sf):
    raw = I.parse_dates(I.upper_country(I.strip_columns(raw_chart_csv(spark, sf))))
    return I.drop_missing_keys(raw)


@q("ing_market_filter", "SELECT * FROM ing_market")
def ing_market_filter(spark, sf):
    raw = I.parse_dates(I.upper_country(I.strip_columns(raw_chart_csv(spark, sf))))
    return I.market_filter(I.drop_missing_keys(raw), markets(spark, sf))


@q("ing_date_window", "SELECT * FROM ing_window")
def ing_date_window(spark, sf):
    raw = raw_chart_csv(spark, sf)
    df = I.parse_dates(I.upper_country(I.strip_columns(raw)))
    df = I.market_filter(I.drop_missing_keys(df), markets(spark, sf))
    return I.date_window(df, I.max_date(raw), 90)


@q("ing_to_numeric", "SELECT * FROM ing_numeric")
def ing_to_numeric(spark, sf):
    return ing_date_window(spark, sf).transform(I.to_numeric)


@q("ing_project_order", "SELECT * FROM ing_out")
def ing_project_order(spark, sf):
    return ingested(spark, sf)


@q("stream_ingest_charts", "SELECT * FROM ing_out")
def stream_ingest_charts(spark, sf):
    """The chart file ingested by a file stream, eight CSV parts a micro-batch; taken up once per state of the input files."""
    from tidemark.streaming.ingest_stream import ingest_charts_stream, stream_paths
    raw_path = _raw_chart_path(spark, sf)
    run = hashlib.sha256(raw_path.encode()).hexdigest()[:12]
    out, ckpt = stream_paths(FS.io_path(spark, sf, f"stream_ingest-{run}"))
    return ingest_charts_stream(spark, raw_path, out, ckpt, markets=markets(spark, sf), files_per_trigger=8)


@q("ing_filtered_count", "SELECT COUNT(*) AS filtered_rows FROM ing_out")
def ing_filtered_count(spark, sf):
    """The rows that the load of the raw chart table wrote, counted by the write itself."""
    v = written(spark, sf, "raw_chart_table", lambda: ingested(spark, sf))
    return spark.range(1).select(F.lit(v.rows).cast("long").alias("filtered_rows"))


@q("ing_campaigns", "SELECT * FROM (SELECT " + ", ".join(
       (f"upper({_STRIP.format(c=c)}) AS {c}" if c == "COUNTRY" else
        f"{_STRIP.format(c=c)} AS {c}" if c in I.CAMPAIGN_TEXT_COLUMNS else
        f"CAST(TRY_STRPTIME({_STRIP.format(c=c)}, '%Y-%m-%d') AS DATE) AS {c}" if c in I.CAMPAIGN_DATE_COLUMNS else
        f"{whole(_STRIP.format(c=c))} AS {c}" if c in I.CAMPAIGN_LONG_COLUMNS else
        f"TRY_CAST({_STRIP.format(c=c)} AS DOUBLE) AS {c}")
       for c in I.CAMPAIGN_COLUMNS) + " FROM raw_camp) x "
   "WHERE CAMPAIGN_ID IS NOT NULL AND SPOTIFY_ID IS NOT NULL AND COUNTRY IS NOT NULL AND SNAPSHOT_DATE IS NOT NULL")
def ing_campaigns(spark, sf):
    return I.clean_campaigns(raw_campaign_csv(spark, sf))


# ----------------------------------------------------------------------------
# 2.3 Staging
# ----------------------------------------------------------------------------
@q("stg_charts", "SELECT * FROM stg_c")
def stg_charts(spark, sf):
    return S.stage_charts(raw_chart_table(spark, sf))


@q("stg_campaigns", "SELECT * FROM stg_camp")
def stg_campaigns(spark, sf):
    return S.stage_campaigns(raw_campaign_text(spark, sf))


# ----------------------------------------------------------------------------
# 2.4 Aggregations and 2.6 windows on the chart side
# ----------------------------------------------------------------------------
@q("chart_points", "SELECT spotify_id, country, snapshot_date, daily_rank, 201 - daily_rank AS chart_points FROM charts")
def chart_points(spark, sf):
    return W.with_chart_points(_m(spark, sf).charts).select("spotify_id", "country", "snapshot_date",
                                                           "daily_rank", "chart_points")


@q("weekly_aggregates", "SELECT * FROM weekly")
def weekly_aggregates(spark, sf):
    return _m(spark, sf).weekly


@q("weekly_aggregates_coded", "SELECT * FROM weekly")
def weekly_aggregates_coded(spark, sf):
    """The weekly rollup over the chart table with coded texts: no sort for the text maxima."""
    t = tables(spark, sf)
    return X.weekly_from_codes(t.coded_charts, t.text_codes)


@q("model_weekly_growth", "SELECT * FROM growth")
def model_weekly_growth(spark, sf):
    return _m(spark, sf).growth


for _key, _col in (("win_prev_points", "previous_week_chart_points"),
                   ("win_points_change", "wow_chart_points_change"),
                   ("win_growth_rate", "wow_growth_rate")):
    def _mk(col):
        return lambda spark, sf: _m(spark, sf).growth.select(*KEYS3, "weekly_chart_points", col)
    REG[_key] = Query(_mk(_col), f"SELECT spotify_id, country, chart_week, weekly_chart_points, {_col} FROM growth")

for _key, _col in (("win_first_week", "first_chart_week"), ("win_max_points", "max_weekly_chart_points"),
                   ("win_prev_week", "previous_chart_week")):
    def _mk(col):
        return lambda spark, sf: L.with_history(_m(spark, sf).growth_history).select(*KEYS3, col)
    REG[_key] = Query(_mk(_col), f"SELECT spotify_id, country, chart_week, {_col} FROM life")


@q("cross_market_penetration", "SELECT spotify_id, chart_week, n_markets AS cross_market_count FROM spread")
def cross_market_penetration(spark, sf):
    return L.penetration_join_form(_m(spark, sf).growth)


@q("market_average_growth",
   "SELECT spotify_id, chart_week, CAST(rate_sum AS DOUBLE) / n_rates AS selected_market_avg_wow_growth "
   "FROM spread WHERE n_rates > 0")
def market_average_growth(spark, sf):
    g = _m(spark, sf).growth.where(F.col("wow_growth_rate").isNotNull())
    from tidemark.functions.columns import growth_as_decimal
    return (g.groupBy("spotify_id", "chart_week")
             .agg((F.sum(growth_as_decimal()).cast("double") / F.count(F.lit(1)))
                  .alias("selected_market_avg_wow_growth")))


@q("join_penetration", "SELECT g.*, n_markets AS cross_market_count FROM growth g "
   "JOIN (SELECT spotify_id, chart_week, n_markets FROM spread) USING (spotify_id, chart_week)")
def join_penetration(spark, sf):
    m = _m(spark, sf)
    return m.growth.join(L.penetration_join_form(m.growth), ["spotify_id", "chart_week"], "left") \
        .select(*W.GROWTH_COLUMNS, "cross_market_count")


@q("join_market_average", "SELECT g.*, CAST(rate_sum AS DOUBLE) / NULLIF(n_rates, 0) AS selected_market_avg_wow_growth "
   "FROM growth g JOIN (SELECT spotify_id, chart_week, rate_sum, n_rates FROM spread) USING (spotify_id, chart_week)")
def join_market_average(spark, sf):
    m = _m(spark, sf)
    avg = market_average_growth(spark, sf)
    return m.growth.join(avg, ["spotify_id", "chart_week"], "left") \
        .select(*W.GROWTH_COLUMNS, "selected_market_avg_wow_growth")


_LIFE_SELECT = ", ".join(L.LIFE_COLUMNS)


@q("model_lifecycle", f"SELECT {_LIFE_SELECT} FROM life")
def model_lifecycle(spark, sf):
    return _m(spark, sf).life


@q("chain_lifecycle", f"SELECT {_LIFE_SELECT} FROM life")
def chain_lifecycle(spark, sf):
    """The lifecycle table brought forward in four loads of later and later weeks, each from its own charts and the state."""
    chain = WeeklyChain(spark, FS.io_path(spark, sf, "chain-" + hashlib.sha256(inputs_of(spark, sf).encode()).hexdigest()[:12]))
    if chain.last_week is None:
        charts = tables(spark, sf).charts.withColumn("_week", week_of("snapshot_date"))
        first, last = charts.agg(F.min("_week"), F.max("_week")).first()
        cuts = [first + (last - first) * i / 4 for i in range(1, 4)] if first else []
        for lo, hi in zip([None, *cuts], [*cuts, None]):
            part = charts if lo is None else charts.where(F.col("_week") > F.lit(lo))
            chain.advance((part if hi is None else part.where(F.col("_week") <= F.lit(hi))).drop("_week"))
    return chain.life()


for _key in ("lifecycle_stage", "catalog_revival_flag", "market_spike_flag"):
    def _mk(col):
        return lambda spark, sf: _m(spark, sf).life.select(*KEYS3, col)
    REG[_key] = Query(_mk(_key), f"SELECT spotify_id, country, chart_week, {_key} FROM life")


@q("mart_repertoire", "SELECT * FROM rep")
def mart_repertoire(spark, sf):
    return _m(spark, sf).rep


@q("win_market_rank", "SELECT spotify_id, country, chart_week, weekly_chart_points, market_week_rank FROM rep")
def win_market_rank(spark, sf):
    life = _m(spark, sf).life.select(*KEYS3, "weekly_chart_points")
    return M.with_market_rank(life)


for _key in ("repertoire_signal", "release_age_days"):
    def _mk(col):
        def build(spark, sf):
            from tidemark.functions.columns import release_age_days, repertoire_signal
            life = _m(spark, sf).life
            expr = repertoire_signal() if col == "repertoire_signal" else release_age_days()
            return life.select(*KEYS3, expr.alias(col))
        return build
    REG[_key] = Query(_mk(_key), f"SELECT spotify_id, country, chart_week, {_key} FROM rep")


@q("country_week_summary", "SELECT * FROM summary")
def country_week_summary(spark, sf):
    return M.country_week_summary(_m(spark, sf).life)


@q("multi_market_tracks", "SELECT country, chart_week, multi_market_tracks FROM summary")
def multi_market_tracks(spark, sf):
    return M.country_week_summary(_m(spark, sf).life).select("country", "chart_week", "multi_market_tracks")


@q("cross_market_champions", "SELECT country, chart_week, cross_market_champions FROM summary")
def cross_market_champions(spark, sf):
    return M.country_week_summary(_m(spark, sf).life).select("country", "chart_week", "cross_market_champions")


@q("win_top_track", "SELECT country, chart_week, top_spotify_id, top_track_name, top_artists, "
   "top_track_chart_points FROM mkt")
def win_top_track(spark, sf):
    return M.top_track(_m(spark, sf).life)


@q("join_top_track", "SELECT * FROM mkt")
def join_top_track(spark, sf):
    life = _m(spark, sf).life
    return M.join_top_track(M.country_week_summary(life), life)


@q("mart_market_trends", "SELECT * FROM mkt")
def mart_market_trends(spark, sf):
    return _m(spark, sf).mkt


# ----------------------------------------------------------------------------
# Campaigns: 2.4, 2.5, 2.7, 2.8, 2.11
# ----------------------------------------------------------------------------
@q("campaign_week", "SELECT campaign_id, campaign_week FROM cbase")
def campaign_week(spark, sf):
    return C.campaign_base(_m(spark, sf).campaigns).select("campaign_id", "campaign_week")


@q("join_campaign_market", "SELECT * FROM cmarket")
def join_campaign_market(spark, sf):
    t = tables(spark, sf)
    return C.join_campaign_market(t.campaigns, t.life)


@q("join_control", "SELECT campaign_id, m.market AS control_country, m.rate AS wow_growth_rate "
   "FROM (SELECT b.campaign_id, b.country, UNNEST(s.markets) AS m FROM cbase b, spread s "
   "WHERE b.spotify_id = s.spotify_id AND b.campaign_week = s.chart_week) u "
   "WHERE m.market <> country AND m.rate IS NOT NULL", rounded=True)
def join_control(spark, sf):
    t = tables(spark, sf)
    return C.join_control(t.campaign_keys, finalize(t.growth_rates))      # a rate goes to many rows, and rounding is the dearest part of a row


@q("control_market_growth", "SELECT * FROM ccontrol")
def control_market_growth(spark, sf):
    t = tables(spark, sf)
    return C.control_market_growth(t.campaigns, t.life)


@q("join_control_back", "SELECT * EXCLUDE (cost_per_stream, roas_proxy) FROM cmetrics")
def join_control_back(spark, sf):
    t = tables(spark, sf)
    return C.join_control_back(t.campaigns, t.life)


@q("cost_per_stream", "SELECT campaign_id, spend_eur / CAST(NULLIF(attributed_streams, 0) AS DOUBLE) "
   "AS cost_per_stream FROM campaigns")
def cost_per_stream(spark, sf):
    from tidemark.functions.columns import cost_per_stream as cps
    return _m(spark, sf).campaigns.select("campaign_id", cps().alias("cost_per_stream"))


@q("roas_proxy", "SELECT campaign_id, CAST(attributed_streams * 0.004 AS DOUBLE) / NULLIF(spend_eur, 0) "
   "AS roas_proxy FROM campaigns")
def roas_proxy(spark, sf):
    from tidemark.functions.columns import roas_proxy as roas
    return _m(spark, sf).campaigns.select("campaign_id", roas().alias("roas_proxy"))


@q("channel_benchmarks", "SELECT channel, AVG(spend_eur / CAST(NULLIF(attributed_streams, 0) AS DOUBLE)) "
   "AS channel_avg_cost_per_stream FROM campaigns "
   "WHERE spend_eur / CAST(NULLIF(attributed_streams, 0) AS DOUBLE) IS NOT NULL GROUP BY channel")
def channel_benchmarks(spark, sf):
    from tidemark.functions.columns import cost_per_stream as cps
    return C.channel_benchmarks(_m(spark, sf).campaigns.withColumn("cost_per_stream", cps()))


@q("join_channel_benchmark", "SELECT * EXCLUDE (campaign_efficiency_alert, campaign_performance_signal) FROM camp")
def join_channel_benchmark(spark, sf):
    t = tables(spark, sf)
    return C.join_channel_benchmark(C.campaign_metrics(t.campaigns, t.life))


for _key in ("lift_vs_control", "campaign_efficiency_alert", "campaign_performance_signal"):
    def _mk(col):
        return lambda spark, sf: tables(spark, sf).models.camp.select("campaign_id", col)
    REG[_key] = Query(_mk(_key), f"SELECT campaign_id, {_key} FROM camp")


@q("lift_bubble_size", "SELECT campaign_id, GREATEST(ABS(COALESCE(lift_vs_control, 0.0)), CAST(0.01 AS DOUBLE)) "
   "AS lift_size FROM camp")
def lift_bubble_size(spark, sf):
    from tidemark.functions.columns import lift_bubble_size as lbs
    return tables(spark, sf).models.camp.select("campaign_id", lbs().alias("lift_size"))


@q("mart_campaign_performance", "SELECT * FROM camp")
def mart_campaign_performance(spark, sf):
    return tables(spark, sf).models.camp


# ----------------------------------------------------------------------------
# 2.4 / 2.9 Dashboard
# ----------------------------------------------------------------------------
_PICKED_SQL = "country IN (" + ", ".join(f"'{c}'" for c in PICKED) + ")"
_RANGE_SQL = f"{_PICKED_SQL} AND chart_week BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"


@q("dash_filter_rep", f"SELECT * FROM rep WHERE {_RANGE_SQL}")
def dash_filter_rep(spark, sf):
    return D.filter_rep(tables(spark, sf).rep, RANGE_FILTER)


@q("dash_filter_mkt", f"SELECT * FROM mkt WHERE {_RANGE_SQL}")
def dash_filter_mkt(spark, sf):
    return D.filter_mkt(tables(spark, sf).mkt, RANGE_FILTER)


@q("dash_filter_camp", f"SELECT * FROM camp WHERE {_PICKED_SQL}")
def dash_filter_camp(spark, sf):
    return D.filter_camp(tables(spark, sf).camp, DashboardFilter(countries=PICKED))


@q("dash_date_bounds", "SELECT MIN(chart_week) AS min_date, MAX(chart_week) AS max_date FROM life")
def dash_date_bounds(spark, sf):
    return D.date_bounds(tables(spark, sf).rep)


@q("dash_countries", "SELECT DISTINCT country FROM life WHERE country IS NOT NULL")
def dash_countries(spark, sf):
    return D.countries(tables(spark, sf).rep)


@q("dash_rep_headline", "SELECT COUNT(DISTINCT spotify_id) AS total_tracks, AVG(wow_growth_rate) AS avg_wow_growth, "
   "CAST(COUNT_IF(catalog_revival_flag) AS BIGINT) AS catalog_revivals, "
   "CAST(COUNT_IF(market_spike_flag) AS BIGINT) AS market_spikes FROM life")
def dash_rep_headline(spark, sf):
    return D.rep_headline(D.filter_rep(tables(spark, sf).rep, ALL))


_DISTINCT_SQL = ("COUNT(DISTINCT spotify_id) AS total_tracks, COUNT(DISTINCT spotify_id) FILTER (cross_market_count >= 5) AS multi_market_tracks, "
                 "COUNT(DISTINCT spotify_id) FILTER (cross_market_count >= 8) AS cross_market_champions FROM life")


@q("dash_distinct_tracks", f"SELECT {_DISTINCT_SQL} WHERE {_RANGE_SQL}")
def dash_distinct_tracks(spark, sf):
    """Distinct tracks of the selected markets and weeks, from the bitmaps alone."""
    return DI.distinct_items(D.filter_mkt(tables(spark, sf).item_bitmaps, RANGE_FILTER))


@q("distinct_tracks_by_market", f"SELECT country, {_DISTINCT_SQL} GROUP BY country")
def distinct_tracks_by_market(spark, sf):
    return DI.distinct_items(tables(spark, sf).item_bitmaps, ("country",))


@q("dash_lifecycle_counts", "SELECT lifecycle_stage, COUNT(*) AS row_count FROM life "
   "WHERE lifecycle_stage IS NOT NULL GROUP BY lifecycle_stage")
def dash_lifecycle_counts(spark, sf):
    return D.lifecycle_counts(D.filter_rep(tables(spark, sf).rep, ALL))


@q("dash_top_tracks", "SELECT track_name, artists, CAST(SUM(weekly_chart_points) AS BIGINT) AS weekly_chart_points "
   "FROM life WHERE track_name IS NOT NULL AND artists IS NOT NULL GROUP BY track_name, artists "
   "ORDER BY weekly_chart_points DESC, track_name, artists LIMIT 10")
def dash_top_tracks(spark, sf):
    return D.top_tracks(D.filter_rep(tables(spark, sf).rep, ALL))


@q("dash_top_signals", "SELECT track_name, artists, country, chart_week, weekly_chart_points, wow_growth_rate, "
   "lifecycle_stage, repertoire_signal, cross_market_count FROM rep "
   "ORDER BY weekly_chart_points DESC, spotify_id, country, chart_week LIMIT 50")
def dash_top_signals(spark, sf):
    return D.top_signals(D.filter_rep(tables(spark, sf).rep, ALL))


@q("dash_market_series", "SELECT country, chart_week, total_chart_points FROM mkt")
def dash_market_series(spark, sf):
    return D.market_series(D.filter_mkt(tables(spark, sf).mkt, ALL))


@q("dash_latest_week", "SELECT country, chart_week, total_chart_points FROM mkt "
   "WHERE chart_week = (SELECT MAX(chart_week) FROM mkt)")
def dash_latest_week(spark, sf):
    return D.latest_week(D.filter_mkt(tables(spark, sf).mkt, ALL))


@q("dash_market_table", "SELECT country, chart_week, tracks_tracked, total_chart_points, growing_tracks, "
   "declining_tracks, market_spike_count, top_track_name, top_artists FROM mkt")
def dash_market_table(spark, sf):
    return D.market_table(D.filter_mkt(tables(spark, sf).mkt, ALL))


@q("dash_market_headline", "SELECT CAST(SUM(market_spike_count) AS BIGINT) AS total_market_spikes, "
   "CAST(SUM(multi_market_tracks) AS BIGINT) AS multi_market_tracks, "
   "CAST(SUM(cross_market_champions) AS BIGINT) AS cross_market_champions, "
   "AVG(avg_wow_growth_rate) AS avg_market_growth FROM mkt")
def dash_market_headline(spark, sf):
    return D.market_headline(D.filter_mkt(tables(spark, sf).mkt, ALL))


@q("dash_campaign_headline", "SELECT CAST(SUM(CAST(spend_eur AS DECIMAL(18,4))) AS DOUBLE) AS total_spend, "
   "AVG(roas_proxy) AS avg_roas, AVG(cost_per_stream) AS avg_cps, COUNT(DISTINCT campaign_id) AS campaigns FROM camp")
def dash_campaign_headline(spark, sf):
    return D.campaign_headline(D.filter_camp(tables(spark, sf).camp, ALL))


@q("dash_channel_roas", "SELECT channel, AVG(roas_proxy) AS roas_proxy FROM camp "
   "WHERE channel IS NOT NULL GROUP BY channel")
def dash_channel_roas(spark, sf):
    return D.channel_roas(D.filter_camp(tables(spark, sf).camp, ALL))


@q("dash_campaign_table", "SELECT campaign_id, track_name, artists, country, channel, spend_eur, attributed_streams, "
   "cost_per_stream, roas_proxy, lift_vs_control, campaign_efficiency_alert, campaign_performance_signal FROM camp")
def dash_campaign_table(spark, sf):
    return D.campaign_table(D.filter_camp(tables(spark, sf).camp, ALL))


@q("dash_spend_streams", "SELECT campaign_id, spend_eur, attributed_streams, channel, "
   "GREATEST(ABS(COALESCE(lift_vs_control, 0.0)), CAST(0.01 AS DOUBLE)) AS lift_size, track_name, artists, country, "
   "lift_vs_control, campaign_performance_signal FROM camp")
def dash_spend_streams(spark, sf):
    return D.spend_streams(D.filter_camp(tables(spark, sf).camp, ALL))


# ----------------------------------------------------------------------------
# Validation and campaign construction (2.4, 2.5, 2.9, 2.10)
# ----------------------------------------------------------------------------
@q("val_row_counts", "SELECT (SELECT COUNT(*) FROM charts) AS spotify_rows, "
   "(SELECT COUNT(*) FROM campaigns) AS campaign_rows")
def val_row_counts(spark, sf):
    m = tables(spark, sf)
    return Q.row_counts(m.charts, m.campaigns)


@q("val_generation_mix", "SELECT generation_type, COUNT(*) AS row_count FROM campaigns GROUP BY generation_type")
def val_generation_mix(spark, sf):
    return Q.generation_mix(tables(spark, sf).campaigns)


@q("val_join_integrity", "SELECT COUNT(*) AS matching_campaign_rows FROM campaigns c JOIN charts s "
   "ON c.spotify_id = s.spotify_id AND c.country = s.country AND c.snapshot_date = s.snapshot_date")
def val_join_integrity(spark, sf):
    m = tables(spark, sf)
    return Q.join_integrity(m.campaigns, m.charts)


@q("val_preview", "SELECT * FROM charts ORDER BY spotify_id, country, snapshot_date LIMIT 10")
def val_preview(spark, sf):
    return Q.preview(tables(spark, sf).charts, ["spotify_id", "country", "snapshot_date"])


@q("val_preview_campaigns", "SELECT * FROM campaigns ORDER BY campaign_id LIMIT 10")
def val_preview_campaigns(spark, sf):
    return Q.preview(tables(spark, sf).campaigns, ["campaign_id"])


@q("campaign_orphans", "SELECT c.* FROM campaigns c WHERE NOT EXISTS (SELECT 1 FROM charts s "
   "WHERE s.spotify_id = c.spotify_id AND s.country = c.country AND s.snapshot_date = c.snapshot_date)")
def campaign_orphans(spark, sf):
    m = tables(spark, sf)
    return Q.campaign_orphans(m.campaigns, m.charts)


O.CTES["anchors"] = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY spotify_id, country, snapshot_date ORDER BY daily_rank) AS rn
    FROM charts) x WHERE rn = 1"""
_DRAW = "md5(concat_ws('#', '{seed}', spotify_id, country, CAST(snapshot_date AS VARCHAR)))"
O.CTES["anchor_pick"] = f"""
  SELECT spotify_id, country, snapshot_date, track_name, artists, daily_rank, generation_type, _draw FROM (
    SELECT *, ROW_NUMBER() OVER (ORDER BY _side, _draw, spotify_id, country, snapshot_date) AS _pick FROM (
      (SELECT spotify_id, country, snapshot_date, track_name, artists, daily_rank,
              'movement_anchored' AS generation_type, {_DRAW.format(seed=42)} AS _draw, 0 AS _side
       FROM anchors WHERE TRY_CAST(CAST(daily_movement AS VARCHAR) AS DOUBLE) > 0
       ORDER BY _draw, spotify_id, country, snapshot_date LIMIT 30)
      UNION ALL
      (SELECT spotify_id, country, snapshot_date, track_name, artists, daily_rank,
              'random_timing' AS generation_type, {_DRAW.format(seed=43)} AS _draw, 1 AS _side
       FROM anchors ORDER BY _draw, spotify_id, country, snapshot_date LIMIT 50)) u) v
  WHERE _pick <= 50"""
_X = "(date_diff('day', DATE '1970-01-01', snapshot_date) + daily_rank)"
_LEAD = (f"CASE WHEN generation_type = 'movement_anchored' THEN 2 + ({_X} % 2) ELSE ({_X} % 11) END")
O.CTES["anchor_dates"] = f"""
  SELECT *, CAST(snapshot_date - CAST({_LEAD} AS INTEGER) AS DATE) AS campaign_start_date,
         CAST(snapshot_date - CAST({_LEAD} AS INTEGER) + CAST(7 + (({_X} * 7) % 24) AS INTEGER) AS DATE)
           AS campaign_end_date
  FROM anchor_pick"""
_Y = "(date_diff('day', DATE '1970-01-01', snapshot_date) * 7919 + daily_rank * 104729)"
O.CTES["anchor_draws"] = f"""
  SELECT *,
         CASE {_Y} % 4 WHEN 0 THEN 'Spotify Ads' WHEN 1 THEN 'TikTok' WHEN 2 THEN 'Meta' ELSE 'Editorial Push' END
           AS channel,
         CAST(500 + {_Y} % 49500 AS DOUBLE) + CAST({_Y} % 100 AS DOUBLE) / 100.0 AS spend_eur,
         CAST(0.85 AS DOUBLE) + CAST({_Y} % 31 AS DOUBLE) / 100.0 AS jitter,
         CAST(0.005 AS DOUBLE) + CAST({_Y} % 26 AS DOUBLE) / 1000.0 AS ctr_raw,
         CAST(0.05 AS DOUBLE) + CAST({_Y} % 21 AS DOUBLE) / 100.0 AS conversion_raw,
         CAST(1.0 AS DOUBLE) + CAST({_Y} % 21 AS DOUBLE) / 10.0 AS multiplier
  FROM anchor_dates"""
O.CTES["anchor_funnel1"] = """
  SELECT *, CAST(FLOOR(spend_eur / CASE channel WHEN 'Spotify Ads' THEN CAST(8.0 AS DOUBLE)
                 WHEN 'TikTok' THEN CAST(6.0 AS DOUBLE) WHEN 'Meta' THEN CAST(5.0 AS DOUBLE)
                 WHEN 'Editorial Push' THEN CAST(2.0 AS DOUBLE) END
                 * CAST(1000.0 AS DOUBLE) * jitter) AS BIGINT) AS impressions
  FROM anchor_draws"""
O.CTES["anchor_funnel"] = """
  SELECT *, GREATEST(CAST(1 AS BIGINT), CAST(FLOOR(clicks * conversion_raw * multiplier) AS BIGINT))
           AS attributed_streams,
         ROUND(ctr_raw, 4) AS ctr, ROUND(conversion_raw, 4) AS conversion_rate
  FROM (SELECT *, CAST(FLOOR(impressions * ctr_raw) AS BIGINT) AS clicks FROM anchor_funnel1) y"""


def _anchors(spark, sf):
    return K.anchor_dedup(_m(spark, sf).charts)


@q("anchor_dedup", "SELECT * FROM anchors")
def anchor_dedup(spark, sf):
    return _anchors(spark, sf)


@q("anchor_positive_movement", "SELECT * FROM anchors WHERE TRY_CAST(CAST(daily_movement AS VARCHAR) AS DOUBLE) > 0")
def anchor_positive_movement(spark, sf):
    return K.positive_movement(_anchors(spark, sf))


@q("anchor_sample", "SELECT spotify_id, country, snapshot_date, track_name, artists, daily_rank, generation_type "
   "FROM anchor_pick")
def anchor_sample(spark, sf):
    return K.anchor_sample(_anchors(spark, sf)).drop("_draw")


@q("campaign_dates", "SELECT spotify_id, country, snapshot_date, generation_type, campaign_start_date, "
   "campaign_end_date FROM anchor_dates")
def campaign_dates(spark, sf):
    return K.campaign_dates(K.anchor_sample(_anchors(spark, sf))) \
        .select("spotify_id", "country", "snapshot_date", "generation_type", "campaign_start_date",
                "campaign_end_date")


@q("campaign_funnel", "SELECT spotify_id, country, snapshot_date, channel, spend_eur, impressions, clicks, ctr, "
   "conversion_rate, attributed_streams FROM anchor_funnel")
def campaign_funnel(spark, sf):
    s = K.campaign_funnel(K.draw_parameters(K.campaign_dates(K.anchor_sample(_anchors(spark, sf)))))
    return s.select("spotify_id", "country", "snapshot_date", "channel", "spend_eur", "impressions", "clicks",
                    "ctr", "conversion_rate", "attributed_streams")


# ----------------------------------------------------------------------------
# 2.12 Data quality
# ----------------------------------------------------------------------------
# the staged tables carry the faults of the raw text
_STAGED = {"charts": "stg_c", "campaigns": "stg_camp"}
NOT_NULL = {
    "charts": ("spotify_id", "country", "snapshot_date"),
    "campaigns": ("campaign_id", "spotify_id", "country", "snapshot_date"),
    "weekly": ("spotify_id", "country", "chart_week", "weekly_chart_points"),
    "growth": ("spotify_id", "country", "chart_week", "weekly_chart_points"),
    "life": ("spotify_id", "country", "chart_week", "lifecycle_stage"),
    "rep": ("spotify_id", "country", "chart_week", "lifecycle_stage", "repertoire_signal"),
    "mkt": ("country", "chart_week", "tracks_tracked", "total_chart_points"),
    "camp": ("campaign_id", "spotify_id", "country", "channel", "spend_eur", "attributed_streams"),
}


CHECKS = {t: Q.Checks(not_null=c) for t, c in NOT_NULL.items()}
_UNIQUE = (("campaigns", "campaign_id"), ("camp", "campaign_id"))
_ACCEPTED = (("life", "lifecycle_stage"), ("rep", "lifecycle_stage"))
_GRAIN = (("weekly", ("spotify_id", "country", "chart_week")), ("life", ("spotify_id", "country", "chart_week")),
          ("mkt", ("country", "chart_week")), ("camp", ("campaign_id",)))


def checked(spark, sf) -> dict[str, Callable[[], DataFrame]]:
    """Tables the checks run on: the staged raw text, the marts, and views computed over them, each made when asked for."""
    t = tables(spark, sf)
    m = Models(spark, sf, charts=lambda: t.charts)
    return {"charts": lambda: stg_charts(spark, sf), "campaigns": lambda: stg_campaigns(spark, sf), "weekly": lambda: m.weekly,
            "growth": lambda: m.growth, "life": lambda: t.life, "rep": lambda: t.rep, "mkt": lambda: t.mkt, "camp": lambda: t.camp}


@q("dq_not_null", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
    f"CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS failing_rows FROM {_STAGED.get(t, t)}"
    for t, cols in NOT_NULL.items() for c in cols))
def dq_not_null(spark, sf):
    return Q.report(checked(spark, sf), CHECKS)


@q("dq_unique", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'unique' AS check_name, COUNT(*) AS failing_rows "
    f"FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1) d" for t, c in _UNIQUE)
   .replace("FROM campaigns", "FROM stg_camp"))
def dq_unique(spark, sf):
    return Q.report(checked(spark, sf), {t: Q.Checks(unique=(c,)) for t, c in _UNIQUE})


@q("dq_accepted_values", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'lifecycle_stage' AS column_name, 'accepted_values' AS check_name, "
    f"CAST(COUNT_IF(lifecycle_stage IS NOT NULL AND lifecycle_stage NOT IN "
    f"('Debut', 'Growing', 'Peak', 'Declining', 'Revived', 'Stable')) AS BIGINT) AS failing_rows FROM {t}"
    for t in ("life", "rep")))
def dq_accepted_values(spark, sf):
    return Q.report(checked(spark, sf), {t: Q.Checks(accepted=((c, LIFECYCLE_STAGES),)) for t, c in _ACCEPTED})


@q("dq_grain", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{','.join(k)}' AS column_name, 'grain' AS check_name, COUNT(*) AS failing_rows "
    f"FROM (SELECT {', '.join(k)} FROM {t} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1) d" for t, k in _GRAIN))
def dq_grain(spark, sf):
    return Q.report(checked(spark, sf), {t: Q.Checks(grain=(k,)) for t, k in _GRAIN})


@q("dq_report", " UNION ALL ".join(f"({REG[k].sql})" for k in ("dq_not_null", "dq_unique", "dq_accepted_values", "dq_grain")))
def dq_report(spark, sf):
    """All checks at once: one scan a table."""
    of = lambda found, t: tuple(c for name, c in found if name == t)
    accepted = {t: tuple((c, LIFECYCLE_STAGES) for c in of(_ACCEPTED, t)) for t in NOT_NULL}
    return Q.report(checked(spark, sf), {t: Q.Checks(c, of(_UNIQUE, t), accepted[t], of(_GRAIN, t)) for t, c in NOT_NULL.items()})


# ----------------------------------------------------------------------------
# Public surface
# ----------------------------------------------------------------------------
_DOUBLES_FILE = os.path.join(os.path.dirname(__file__), "doubles.json")


def _doubles() -> dict[str, list[str]]:
    try:
        with open(_DOUBLES_FILE) as fh:
            return json.load(fh)
    except FileNotFoundError:
        return {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(v):
        def query(spark, sf_dir):
            token = _look.set({})
            try:
                df = v.build(spark, sf_dir)
                return df if v.rounded else finalize(df)
            finally:
                _look.reset(token)
        return query
    return {k: wrap(v) for k, v in REG.items()}


def oracle_sql() -> dict[str, str]:
    dbl = _doubles()
    return {k: O.round_doubles(O.with_ctes(v.sql), dbl.get(k, ())) for k, v in REG.items() if v.sql}


def double_columns(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """DOUBLE output columns of every query (schema analysis only, no job).

    A few queries first write a derived file; that part does run.
    """
    out = {}
    for k, v in REG.items():
        schema = v.build(spark, sf_dir).schema
        out[k] = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
    return out


if __name__ == "__main__":  # regenerate doubles.json
    import sys
    from tidemark.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[4]", shuffle_partitions=4)
    with open(_DOUBLES_FILE, "w") as fh:
        json.dump(double_columns(spark, sf), fh, indent=1, sort_keys=True)
    print("wrote", _DOUBLES_FILE)
