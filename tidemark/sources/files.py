"""CSV sources and Parquet sinks.

Raw files are read with an explicit all-string schema (no inference pass,
no type guessing); typing happens in the cleaning and staging steps with
``try_*`` casts.  Outputs go to the shared folder named by
``spark.checkpoint.dir`` unless a path is given.
"""

from __future__ import annotations

import hashlib
import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.text import PANDAS_NULL_TOKENS, null_tokens
from tidemark.session import checkpoint_dir
from tidemark.sources import versions
from tidemark.sources.csv_ranges import read_quoted_csv


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str],
             pandas_null_tokens: bool = False, multiline: bool = False, whole_files: bool = False) -> DataFrame:
    """``src_chart_csv`` / ``src_campaign_csv``: header CSV, every column as text.

    Quoted fields may hold commas.  Empty fields are null; with ``pandas_null_tokens`` the pandas
    reader's list (NA, None, ...) is null too.

    A large file is split by ``spark.sql.files.maxPartitionBytes``.  With ``multiline`` quoted
    fields may hold line breaks: record ends are found in parallel (``sources/csv_ranges.py``; one
    more pass over the files).  ``whole_files`` reads each file whole in one task instead.
    """
    if multiline and not whole_files:
        df = read_quoted_csv(spark, path, columns)
    else:
        df = (spark.read.schema(string_schema(columns))
              .option("header", True).option("escape", '"').option("multiLine", whole_files)
              .option("enforceSchema", False)
              .csv(path))
    if pandas_null_tokens:
        df = df.select(*[null_tokens(c, PANDAS_NULL_TOKENS).alias(c) for c in columns])
    return df


def write_csv(df: DataFrame, path: str) -> str:
    """``sink_filtered_csv``: replace the file set, header in every part; values keep their outer spaces."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """``sink_raw_table`` / ``sink_mart``: replace the Parquet table at ``path`` in one step.

    Returns the folder of the new version; ``read_written`` finds the current one.  A load that
    fails leaves the table as it was (``sources/versions.py``).
    """
    return versions.replace(df, path, partition_by).folder


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a table that ``write_table`` wrote."""
    now = versions.current(spark, path)
    if now is None:
        raise ValueError(f"no table was written at {path}")
    return now.read(spark)


def io_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A stable location for files derived from the tables at ``sf_dir``."""
    tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    return os.path.join(checkpoint_dir(spark), "tidemark-io", tag, name)


def as_text(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename and cast every column to text (how a raw file carries it)."""
    return df.selectExpr(*[f"CAST(`{src}` AS STRING) AS `{dst}`" for src, dst in names.items()])
