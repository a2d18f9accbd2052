"""The item-market chain kept up week by week.

A full build reads all charts to know, for every item and market, the last charted week, its
points and the best week.  Those are a small state here.  ``advance`` takes the charts of new
weeks and reads nothing else but the state:

* the state's last week stands in as one row before the new ones, so LAG works on state + new rows;
* market statistics of an item-week lie within the new rows;
* the new state is an aggregate of the old one and the new rows.

History is appended, never rewritten.  A later best week changes the stage of earlier weeks
(``Peak`` compares with the best of all), so the stage is the one column that is not stored: readers
take the best week from the state.

State, history parts and the last week are one pointer, replaced in one step
(``sources/versions.py``): an ``advance`` that fails leaves the chain as it was.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import catalog_revival_flag, lifecycle_stage, market_spike_flag
from tidemark.operators.lifecycle import LIFE_COLUMNS, with_market_stats
from tidemark.operators.weekly import WEEKLY_COLUMNS, weekly_aggregates, weekly_growth
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds
from tidemark.sources import versions

KEYS = ("spotify_id", "country")
STORED = tuple(c for c in LIFE_COLUMNS if c != "lifecycle_stage") + ("gap_days",)


def next_state(state: DataFrame | None, weekly: DataFrame) -> DataFrame:
    """Per item and market: first, last and best week so far."""
    new = weekly.select(*KEYS, F.col("chart_week").alias("last_week"), F.col("weekly_chart_points").alias("last_points"),
                        F.col("chart_week").alias("first_week"), F.col("weekly_chart_points").alias("best_points"))
    both = state.unionByName(new) if state is not None else new
    return both.groupBy(*KEYS).agg(F.max("last_week").alias("last_week"), F.max_by("last_points", "last_week").alias("last_points"),
                                   F.min("first_week").alias("first_week"), F.max("best_points").alias("best_points"))


def new_rows(state: DataFrame | None, weekly: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The lifecycle rows of new weeks, without their stage."""
    rows = weekly.withColumn("_old", F.lit(False))
    if state is not None:
        held = {"chart_week": "last_week", "weekly_chart_points": "last_points", "spotify_id": "spotify_id", "country": "country"}
        kinds = {f.name: f.dataType for f in weekly.schema.fields}
        before = state.select(*[(F.col(held[c]) if c in held else F.lit(None)).cast(kinds[c]).alias(c) for c in WEEKLY_COLUMNS], F.lit(True).alias("_old"))
        rows = rows.unionByName(before)
    # the old rows are dropped above the windows: an old row is the first of its item and market and has no row before it
    grown = weekly_growth(rows, keep_history=True, carry=("_old",)).where("not _old").drop("_old")
    return (with_market_stats(grown, t)
            .withColumn("gap_days", F.datediff("chart_week", "previous_chart_week"))
            .withColumn("catalog_revival_flag", catalog_revival_flag(t=t))
            .withColumn("market_spike_flag", market_spike_flag(t=t))
            .select(*STORED))


class WeeklyChain:
    """The lifecycle table at ``folder``, brought forward by ``advance``."""

    def __init__(self, spark: SparkSession, folder: str, t: Thresholds = DEFAULT_THRESHOLDS):
        self.spark, self.folder, self.t = spark, folder, t

    def _pointer(self) -> dict:
        text = versions.get(self.spark, f"{self.folder}/{versions.POINTER}")
        return json.loads(text) if text else {"last_week": None, "state": None, "before": None, "parts": []}

    @property
    def last_week(self) -> dt.date | None:
        week = self._pointer()["last_week"]
        return dt.date.fromisoformat(week) if week else None

    def state(self) -> DataFrame | None:
        held = self._pointer()["state"]
        return self.spark.read.parquet(f"{self.folder}/{held}") if held else None

    def advance(self, charts: DataFrame) -> int:
        """Take up the charts of whole weeks after ``last_week``; returns the number of new rows.

        Rows of a week that is closed already are an error: the chain would have to be built again.
        """
        pointer, state = self._pointer(), self.state()
        closed = F.lit(pointer["last_week"]).cast("date")
        week = F.col("chart_week")
        message = F.concat(F.lit("the week "), week.cast("string"), F.lit(" is closed"))
        weekly = weekly_aggregates(charts, self.t)
        if pointer["last_week"]:
            weekly = weekly.withColumn("chart_week", F.when(week <= closed, F.raise_error(message).cast("date")).otherwise(week))
        once = versions.write_version(weekly, f"{self.folder}/weekly")      # read three times below
        weekly = once.read(self.spark)
        part = versions.write_version(new_rows(state, weekly, self.t), f"{self.folder}/part")
        after = versions.write_version(next_state(state, weekly), f"{self.folder}/state")
        newest = weekly.agg(F.max("chart_week")).first()[0]
        if newest is not None:
            inside = lambda v: v.folder.removeprefix(f"{self.folder}/")
            versions.put(self.spark, f"{self.folder}/{versions.POINTER}",
                         json.dumps({"last_week": newest.isoformat(), "state": inside(after), "before": pointer["state"],
                                     "parts": pointer["parts"] + [inside(part)]}))
            if pointer["before"]:           # readers may still hold the state before this one, not an older one
                versions.drop(self.spark, f"{self.folder}/{pointer['before']}")
        versions.drop(self.spark, once.folder)
        return part.rows if newest is not None else 0

    def life(self) -> DataFrame:
        """``model_lifecycle`` of all weeks so far: the stored rows, their stage by the best week in the state."""
        pointer = self._pointer()
        if not pointer["parts"]:
            raise ValueError("the chain holds no week yet")
        rows = self.spark.read.parquet(*[f"{self.folder}/{p}" for p in pointer["parts"]])
        best = self.state().select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("best_points").alias("max_weekly_chart_points"))
        same = F.lit(True)
        for k in KEYS:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return rows.join(best, same).withColumn("lifecycle_stage", lifecycle_stage(t=self.t)).select(*LIFE_COLUMNS)
