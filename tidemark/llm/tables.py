"""Tables written once in the shared folder that the session names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import write_once as written

__all__ = ["written", "partitions"]


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
