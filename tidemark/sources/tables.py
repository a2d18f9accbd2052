"""Scans of parquet tables with explicit column lists (pruned at the scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """``src_table_ref``: scan one table by name; ``columns`` prunes the read schema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
