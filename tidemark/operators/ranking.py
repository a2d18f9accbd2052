"""Row numbers within groups that stay balanced when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sorts every group inside
one task, so a group holding a third of the rows becomes a third of the job
on one core.  Here the rows are range-partitioned on the full sort key
(g, o): a hot group is cut across several contiguous partitions.  Rows carry
``monotonically_increasing_id()`` of their sorted partition, so the rank of a
row is its id minus the least id of its group in the partition, plus the
number of rows the group has in earlier partitions.  Both come from one
aggregate per (partition, group); everything stays in the JVM.

The sorted rows are written once (the range bounds are sampled anew on every
evaluation), so the function runs a job when called.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shuffles_removed, write_once


def _sort_expr(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, tuple):
        name, ascending = c
        return F.col(name).asc_nulls_first() if ascending else F.col(name).desc_nulls_last()
    return F.col(c).asc_nulls_first()


def group_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence, name: str,
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = row_number() within ``group_cols`` by ``order``; no groups: over all rows.

    ``order`` items are column names (ascending), ``(name, ascending)`` pairs
    or Columns; the order must be total within a group for a stable result.
    Null group keys form a group, and no row is lost.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort_key = [F.col(g).asc_nulls_first() for g in group_cols] + [_sort_expr(o) for o in order]
    with shuffles_removed(df.sparkSession):
        local = write_once(df.repartitionByRange(n, *sort_key).sortWithinPartitions(*sort_key)
                           .withColumn("_id", F.monotonically_increasing_id()).withColumn("_pid", F.spark_partition_id()), "ranked")
    pieces = local.groupBy("_pid", *group_cols).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    # a group has one row per partition it reaches; without groups that is one row per partition in all
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    right = pieces.select(F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_o_{g}") for g in group_cols], "_first", "_off")
    cond = F.col("_pid") == F.col("_opid")
    for g in group_cols:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    return local.join(right, cond) \
        .withColumn(name, F.col("_id") - F.col("_first") + F.col("_off") + 1) \
        .drop("_id", "_pid", "_opid", "_first", "_off", *[f"_o_{g}" for g in group_cols])


def window_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence, name: str) -> DataFrame:
    """The plain window form (one task per group); used as a cross-check."""
    w = Window.partitionBy(*group_cols).orderBy(*[_sort_expr(o) for o in order])
    return df.withColumn(name, F.row_number().over(w))


def top1_per_group(df: DataFrame, group_cols: Sequence[str], score: str, tie: str,
                   carry: Sequence[str], prefix: str = "top_") -> DataFrame:
    """Highest ``score`` per group (ties: smallest ``tie``) as an aggregate.

    ``min(struct(-score, tie, ...))`` is combined map-side like any other
    aggregate, so a hot group never reaches one task whole (the window
    ``row_number() = 1`` form needs the group clustered first).
    """
    best = F.min(F.struct(F.col(score).isNull().alias("_none"), (-F.col(score)).alias("_neg"), F.col(tie).alias("_tie"),
                          *[F.col(c).alias(c) for c in carry])).alias("_best")
    out = df.groupBy(*group_cols).agg(best)
    return out.select(*group_cols, *[F.col(f"_best.{c}").alias(f"{prefix}{c}") for c in carry])
