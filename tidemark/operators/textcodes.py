"""Texts as order-preserving numbers, so that MAX and MIN of texts aggregate by hash.

Spark keeps the running MAX of a text in no hash table (a text cannot be updated in place), so
an aggregate with one sorts all its rows.  A dictionary that numbers the distinct texts in their
order turns MAX(text) into MAX(code).  The dictionary is made once per load, the coded table
is what aggregates read, and only the few rows of the result are decoded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import group_row_number
from tidemark.operators.weekly import WEEKLY_COLUMNS, weekly_aggregates
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds

CHART_TEXTS = ("track_name", "artists", "album_name")


def text_codes(df: DataFrame, columns: Sequence[str] = CHART_TEXTS) -> DataFrame:
    """text, code: the distinct texts of ``columns``, numbered in byte order from 1 (no code for null)."""
    texts = reduce(DataFrame.union, [df.select(F.col(c).alias("text")).distinct() for c in columns])
    return group_row_number(texts.where(F.col("text").isNotNull()).distinct(), [], ["text"], "code")


def encode(df: DataFrame, codes: DataFrame, columns: Sequence[str] = CHART_TEXTS) -> DataFrame:
    """``df`` with the codes in place of the texts of ``columns``."""
    return _looked_up(df, codes, columns, "text", "code")


def decode(df: DataFrame, codes: DataFrame, columns: Sequence[str] = CHART_TEXTS) -> DataFrame:
    """``df`` with the texts in place of the codes of ``columns``."""
    return _looked_up(df, codes, columns, "code", "text")


def _looked_up(df: DataFrame, codes: DataFrame, columns: Sequence[str], by: str, to: str) -> DataFrame:
    for i, c in enumerate(columns):
        side = codes.select(F.col(by).alias(f"_by{i}"), F.col(to).alias(f"_to{i}"))
        df = df.join(side, F.col(c) == F.col(f"_by{i}"), "left").withColumn(c, F.col(f"_to{i}")).drop(f"_by{i}", f"_to{i}")
    return df


def weekly_from_codes(coded: DataFrame, codes: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """``weekly_aggregates`` over a coded chart table: a hash aggregate, decoded afterwards."""
    return decode(weekly_aggregates(coded, t), codes).select(*WEEKLY_COLUMNS)
