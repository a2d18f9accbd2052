"""Chart ingestion as a Structured Streaming job whose date window moves with the data.

The reference reads the chart file twice: once for the latest date over all rows, once to clean
and filter chunk by chunk.  A stream cannot know the latest date beforehand, so it is
*state* here: every micro-batch (``maxFilesPerTrigger`` files) is read once; while its cleaned
rows are written, the write observes the latest date of all its rows.  The state then moves the window:

* rows before the window of the state so far are not written at all, since the window only
  moves forward;
* rows that a later batch pushes out of the window expire: readers filter by the window,
  and parts whose newest row is before it leave the table;
* rows of a batch that arrives late stay if the window still holds them.

So files in any order give the rows of the batch ingest.  State, parts and number of the last
batch are one pointer, replaced in one step (``sources/versions.py``): a batch that is tried again
after a failure is taken up once.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import parse_date
from tidemark.operators import ingest as I
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds
from tidemark.sources import versions
from tidemark.sources.files import string_schema

EMPTY = {"last_batch": -1, "max_date": None, "parts": []}


def clean_rows(raw: DataFrame, markets) -> DataFrame:
    """The cleaning of a chunk without the date window."""
    df = I.drop_missing_keys(I.parse_dates(I.upper_country(I.strip_columns(raw))))
    return I.project_order(I.to_numeric(I.market_filter(df, markets)))


def state_of(spark: SparkSession, table: str) -> dict:
    text = versions.get(spark, f"{table}/{versions.POINTER}")
    return json.loads(text) if text else dict(EMPTY)


def _start(max_date: str | None, t: Thresholds) -> dt.date | None:
    return dt.date.fromisoformat(max_date) - dt.timedelta(days=t.ingest_days_back) if max_date else None


def take_batch(raw: DataFrame, batch: int, table: str, markets, t: Thresholds = DEFAULT_THRESHOLDS) -> None:
    """Write the rows of one micro-batch and move the window; a batch that was committed is left alone."""
    spark = raw.sparkSession
    state = state_of(spark, table)
    if batch <= state["last_batch"]:
        return
    seen, kept = Observation(), Observation()
    rows = clean_rows(raw.observe(seen, F.max(parse_date("snapshot_date")).alias("newest")), markets)
    start = _start(state["max_date"], t)
    if start:
        rows = rows.where(F.col("SNAPSHOT_DATE") >= F.lit(start))
    folder = f"part-{uuid.uuid4().hex}"
    rows.observe(kept, F.max("SNAPSHOT_DATE").alias("newest"), F.count(F.lit(1)).alias("rows")).write.parquet(f"{table}/{folder}")
    dates = [d for d in (state["max_date"], seen.get["newest"] and seen.get["newest"].isoformat()) if d]
    parts = state["parts"]
    if kept.get["rows"]:
        parts = parts + [{"folder": folder, "newest": kept.get["newest"].isoformat()}]
    newest = max(dates, default=None)
    start = _start(newest, t)
    parts = [p for p in parts if start is None or p["newest"] >= start.isoformat()]
    versions.put(spark, f"{table}/{versions.POINTER}", json.dumps({"last_batch": batch, "max_date": newest, "parts": parts}))


def read_window(spark: SparkSession, table: str, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The rows within the window of the state; an error if no row so far had a date that can be read."""
    state = state_of(spark, table)
    if state["max_date"] is None:
        raise ValueError(I.NO_DATE)
    schema = clean_rows(spark.createDataFrame([], string_schema(I.CHART_COLUMNS)), ["-"]).schema
    rows = spark.read.schema(schema).parquet(*[f"{table}/{p['folder']}" for p in state["parts"]]) if state["parts"] else spark.createDataFrame([], schema)
    return rows.where(F.col("SNAPSHOT_DATE").between(F.lit(_start(state["max_date"], t)), F.lit(dt.date.fromisoformat(state["max_date"]))))


def ingest_charts_stream(spark: SparkSession, raw_path: str, table: str, checkpoint: str,
                         markets: Sequence[str] | DataFrame | None = None, files_per_trigger: int = 1,
                         t: Thresholds = DEFAULT_THRESHOLDS, multiline: bool = False) -> DataFrame:
    """Take up every new file in ``raw_path`` (trigger ``availableNow``), wait, and return the rows in the window.

    Called again with the same checkpoint it takes up the files that came since.
    """
    raw = (spark.readStream.schema(string_schema(I.CHART_COLUMNS))
           .option("header", True).option("escape", '"').option("multiLine", multiline)
           .option("maxFilesPerTrigger", files_per_trigger)
           .csv(raw_path))
    wanted = markets if markets is not None else t.ingest_markets
    query = (raw.writeStream.foreachBatch(lambda df, batch: take_batch(df, batch, table, wanted, t))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_window(spark, table, t)


def stream_paths(base: str) -> tuple[str, str]:
    return os.path.join(base, "table"), os.path.join(base, "_checkpoint")
