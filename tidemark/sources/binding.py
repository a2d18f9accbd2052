"""Test binding: the driver's order tables read as chart and campaign rows.

No chart table exists in the test data, so a query maps it on:

* item (``spotify_id``, ``track_name``) = part brand, market (``country``) =
  customer nation name, day = ship date;
* ``daily_rank`` = revenue order of the brands within (market, day), revenue
  summed as exact cents, ties broken by item;
* the audio-feature columns are integer-valued measures (counts and sums) so
  every later sum is exact and averages agree across engines.

A campaign is one (order, part), aggregated over all its lines.  The market-day
rank and the places of the part texts are written once by the skew-safe ranker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import group_row_number
from tidemark.session import write_once
from tidemark.sources.tables import read_table


def _orders_with_nation(spark: SparkSession, sf_dir: str, *columns) -> DataFrame:
    """orders -> o_orderkey, _nation (the customer's nation key), ``columns``."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", F.col("c_nationkey").alias("_nation")])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", *columns])
    return orders.join(customer, orders.o_custkey == customer.c_custkey).drop("o_custkey", "c_custkey")


def _with_market(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """``_nation`` -> country.  The names come last, so that shuffled lines hold the key alone."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", F.col("n_name").alias("country")])
    return rows.join(F.broadcast(nation), rows._nation == nation.n_nationkey).drop("_nation", "n_nationkey")


def _ordered(part: DataFrame, text: str, code: str) -> DataFrame:
    """part with ``code``: its place in the order of ``text`` (null: none), so that the greatest code has the greatest text."""
    placed = group_row_number(part, [], [text, "p_partkey"], code)
    return placed.withColumn(code, F.when(F.col(text).isNotNull(), F.col(code)))


#: Chart columns that come from a measure of the (item, market, day) group, and that measure.
MEASURES = {
    "artists": "artists", "album_name": "album_name", "popularity": "popularity", "is_explicit": "_explicit", "duration_ms": "_max_qty",
    "album_release_date": "album_release_date", "danceability": "_lines", "energy": "_qty", "musical_key": "_min_size",
    "loudness": "_lines", "mode": "_lines", "speechiness": "_min_qty", "acousticness": "_tax", "instrumentalness": "_max_qty",
    "liveness": "_min_size", "valence": "_disc"}


def chart_rows(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Staged chart rows (the 25 columns of ``stg_charts``, or those named) from the order tables.

    Lines cross the shuffles as keys and numbers alone.  The greatest type and name of a group are
    taken as places in the order of these texts over all parts: the maxima of numbers need no sort
    of the lines, as those of texts do, and the texts are looked up for the finished groups.
    With ``columns``, every line still counts, but carries only what these columns are made of.
    """
    asked = lambda c: columns is None or c in columns
    # money as exact integer cents (long sums keep HashAggregate and are order independent)
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_quantity", cents("l_extendedprice").alias("_price"), cents("l_discount").alias("_d"),
                     cents("l_tax").alias("_t"), F.col("l_shipdate").cast("date").alias("snapshot_date"),
                     (F.col("l_discount") > 0.05).alias("_deep")])
    orders = _orders_with_nation(spark, sf_dir, F.col("o_orderdate").cast("date").alias("_ordered"))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_name"])
    texts = [x for x in (("_type", "_max_type", "p_type", "artists"), ("_name", "_max_name", "p_name", "album_name")) if asked(x[3])]
    for place, _, text, _ in texts:
        part = _ordered(part, text, place)
    if texts:
        part = write_once(part, "parts")     # the places hold for the lines and for the look-up below
    lines = (li.join(orders, li.l_orderkey == orders.o_orderkey).drop("l_orderkey", "o_orderkey")
               .join(part.select("p_partkey", "p_brand", "p_size", *[place for place, _, _, _ in texts]), F.col("l_partkey") == part.p_partkey))
    day = (_with_market(spark, sf_dir, lines)
           .groupBy(F.col("p_brand").alias("spotify_id"), "country", "snapshot_date")
           .agg(F.sum("_price").alias("_revenue"),
                *[F.max(place).alias(top) for place, top, _, _ in texts],
                F.max("p_size").alias("popularity"),
                F.min("_ordered").alias("album_release_date"),
                F.count(F.lit(1)).alias("_lines"),
                F.sum("l_quantity").alias("_qty"),
                F.min("l_quantity").alias("_min_qty"),
                F.max("l_quantity").alias("_max_qty"),
                F.sum("_d").alias("_disc"),
                F.sum("_t").alias("_tax"),
                F.min("p_size").alias("_min_size"),
                F.max("_deep").alias("_explicit")))
    for place, top, text, name in texts:
        named = part.select(F.col(place).alias("_place"), F.col(text).alias(name)).where("_place IS NOT NULL")
        day = day.join(named, day[top] == named["_place"], "left").drop(top, "_place")
    if columns is not None:                  # the ranker writes its rows
        day = day.select("spotify_id", "country", "snapshot_date", "_revenue", *dict.fromkeys(MEASURES[c] for c in columns if c in MEASURES))
    ranked = group_row_number(day, ["country", "snapshot_date"], [("_revenue", False), ("spotify_id", True)], "daily_rank") \
        .withColumn("daily_rank", F.col("daily_rank").cast("int"))
    by_item = Window.partitionBy("spotify_id", "country").orderBy("snapshot_date")
    made = {
        "spotify_id": F.col("spotify_id"),
        "track_name": F.col("spotify_id"),
        "artists": F.col("artists"),
        "daily_rank": F.col("daily_rank"),
        "daily_movement": F.lag("daily_rank").over(by_item) - F.col("daily_rank"),
        "weekly_movement": F.lit(None).cast("int"),
        "country": F.col("country"),
        "snapshot_date": F.col("snapshot_date"),
        "popularity": F.col("popularity"),
        "is_explicit": F.col("_explicit"),
        "duration_ms": F.col("_max_qty").cast("int") * 1000,
        "album_name": F.col("album_name"),
        "album_release_date": F.col("album_release_date"),
        "danceability": F.col("_lines").cast("double"),
        "energy": F.col("_qty"),
        "musical_key": F.col("_min_size") % 12,
        "loudness": (-F.col("_lines")).cast("double"),
        "mode": (F.col("_lines") % 2).cast("int"),
        "speechiness": F.col("_min_qty"),
        "acousticness": F.col("_tax").cast("double"),
        "instrumentalness": F.col("_max_qty"),
        "liveness": F.col("_min_size").cast("double"),
        "valence": F.col("_disc").cast("double"),
        "tempo": F.floor(F.col("_revenue") / 10000.0).cast("double"),
        "time_signature": F.lit(4),
    }
    return ranked.select(*[made[c].alias(c) for c in (made if columns is None else columns)])


def soiled_charts(raw: DataFrame) -> DataFrame:
    """Raw chart text with faults in about one row of twelve, placed by key arithmetic.

    Padded, lower-case and unknown markets, missing keys, dates that cannot be
    read or are partial, ranks with a fraction, durations beyond 32 bits.
    """
    k = (F.dayofyear(F.col("snapshot_date").cast("date")) * 31 + F.col("daily_rank").cast("int") * 7) % 97
    c = F.col
    return raw.withColumn("_k", k).withColumns({
        "spotify_id": F.when(c("_k") == 1, F.lit(None)).when(c("_k") == 2, F.concat(F.lit("  "), c("spotify_id"), F.lit(" "))).otherwise(c("spotify_id")),
        "name": F.when(c("_k") == 3, F.concat(F.lit("\t"), c("name"), F.lit(" "))).otherwise(c("name")),
        "country": F.when(c("_k") == 4, F.concat(F.lit(" "), F.lower("country"))).when(c("_k") == 5, F.lit("ATLANTIS")).otherwise(c("country")),
        "snapshot_date": F.when(c("_k") == 6, F.lit("not a date")).when(c("_k") == 7, F.lit(None)).otherwise(c("snapshot_date")),
        "album_release_date": F.when(c("_k") == 8, F.lit("1999")).otherwise(c("album_release_date")),
        "daily_rank": F.when(c("_k") == 9, F.concat(c("daily_rank"), F.lit(".7"))).when(c("_k") == 10, F.lit("n/a")).otherwise(c("daily_rank")),
        "duration_ms": F.when(c("_k") == 11, F.lit("3000000000")).otherwise(c("duration_ms")),
    }).drop("_k")


def soiled_campaigns(raw: DataFrame) -> DataFrame:
    """Raw campaign text with faults placed by key arithmetic: as for charts, and ids that repeat."""
    c = F.col
    return raw.withColumn("_k", (c("CLICKS").cast("bigint") / 2).cast("bigint") % 97).withColumns({
        "CAMPAIGN_ID": F.when(c("_k") == 1, F.lit(None)).when(c("_k") == 2, F.lit("CMP_SAME")).otherwise(c("CAMPAIGN_ID")),
        "COUNTRY": F.when(c("_k") == 3, F.concat(F.lit(" "), F.lower("COUNTRY"))).otherwise(c("COUNTRY")),
        "SNAPSHOT_DATE": F.when(c("_k") == 4, F.lit("not a date")).otherwise(c("SNAPSHOT_DATE")),
        "IMPRESSIONS": F.when(c("_k") == 5, F.lit("3000000000")).otherwise(c("IMPRESSIONS")),
        "ATTRIBUTED_STREAMS": F.when(c("_k") == 6, F.concat(c("ATTRIBUTED_STREAMS"), F.lit(".5"))).otherwise(c("ATTRIBUTED_STREAMS")),
        "SPEND_EUR": F.when(c("_k") == 7, F.lit("free")).otherwise(c("SPEND_EUR")),
    }).drop("_k")


def campaign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged campaign rows (the 16 columns of ``stg_campaigns``)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                F.col("l_shipdate").cast("date").alias("_shipped")])
    # lines go by order once, for the aggregate and the join alike; a line without an order joins nothing
    first = (li.where(F.col("l_orderkey").isNotNull()).repartition("l_orderkey").groupBy("l_orderkey", "l_partkey")
               .agg(F.min("_shipped").alias("_shipped"), F.min("l_linenumber").alias("l_linenumber"),
                    (F.sum("l_quantity") > 25).alias("_many"),
                    F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("_cents")))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type"])
    orders = _orders_with_nation(spark, sf_dir, "o_orderpriority")
    rows = (first.join(orders, first.l_orderkey == orders.o_orderkey).drop("o_orderkey")
                 .join(part, F.col("l_partkey") == part.p_partkey).drop("p_partkey"))
    rows = _with_market(spark, sf_dir, rows)
    streams = ((F.col("l_orderkey") * 31 + F.col("l_partkey") * 17) % 100000)
    snapshot = F.col("_shipped")
    start = F.date_sub(snapshot, (F.col("l_orderkey") % 4).cast("int"))
    impressions = streams * 40 + F.col("l_linenumber")
    clicks = streams * 2
    return rows.select(
        F.concat(F.lit("CMP_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_partkey").cast("string")).alias("campaign_id"),
        F.col("p_brand").alias("spotify_id"),
        F.col("p_brand").alias("track_name"),
        F.col("p_type").alias("artists"),
        "country",
        snapshot.alias("snapshot_date"),
        start.alias("campaign_start_date"),
        F.date_add(start, (7 + F.col("l_partkey") % 24).cast("int")).alias("campaign_end_date"),
        F.col("o_orderpriority").alias("channel"),
        (F.col("_cents").cast("double") / 10000.0).alias("spend_eur"),
        impressions.cast("long").alias("impressions"),
        clicks.cast("long").alias("clicks"),
        F.round(clicks.cast("double") / impressions.cast("double"), 4).alias("ctr"),
        F.round(streams.cast("double") / F.nullif(clicks, F.lit(0)).cast("double"), 4).alias("conversion_rate"),
        streams.cast("long").alias("attributed_streams"),
        F.when(F.col("_many"), "movement_anchored").otherwise("random_timing").alias("generation_type"),
    )
