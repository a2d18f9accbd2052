"""Data-quality checks; each returns (table_name, column_name, check_name, failing_rows)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.params import LIFECYCLE_STAGES

RESULT_COLUMNS = ("table_name", "column_name", "check_name", "failing_rows")


def _name(column: str) -> str:
    return ("`" + column.replace("`", "``") + "`").replace("{", "{{").replace("}", "}}")


def _text(value: str) -> str:
    return ("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'").replace("{", "{{").replace("}", "}}")


@dataclass(frozen=True)
class Checks:
    """The checks of one table: columns without nulls, columns without repeated values, columns
    with a list of values (null passes), and keys (null counts as a value)."""
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple], ...] = ()
    grain: tuple[tuple[str, ...], ...] = ()


def compiled(df: DataFrame, table: str, checks: Checks) -> DataFrame:
    """All ``checks`` of a table from ONE scan, with one exchange whatever the number of keys.

    Rows are grouped by key first; the row checks ride along as counts per group (combined
    map-side), so the second, global aggregate adds them up next to the number of groups with
    more than one row.  Several keys share the exchange: each row is expanded to one row a key,
    as Spark does for several DISTINCTs, and its row checks count at the first key only.
    """
    rows = [(c, "not_null", f"{_name(c)} IS NULL") for c in checks.not_null]
    rows += [(c, "accepted_values", f"{_name(c)} NOT IN ({', '.join(map(_text, v))})") for c, v in checks.accepted]
    keys = list(dict.fromkeys([(c,) for c in checks.unique] + list(checks.grain)))
    source, columns, first = "{rows}", "", ""
    if len(keys) > 1:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        used = list(dict.fromkeys(c for k in keys for c in k))
        sets = [f"struct({i} AS _key, " + ", ".join(f"{_name(c) if c in k else f'CAST(NULL AS {kinds[c]})'} AS {_name(c)}" for c in used) + ")"
                for i, k in enumerate(keys)]
        source = f"(SELECT *, explode(array({', '.join(sets)})) AS _set FROM {{rows}})"
        columns = "_set._key, " + ", ".join(f"_set.{_name(c)}" for c in used)
        first = " AND _set._key = 0"
    elif keys:
        columns = ", ".join(map(_name, keys[0]))
    hits = [f"count_if(({test}){first}) AS _row{i}" for i, (_, _, test) in enumerate(rows)]
    groups = ", ".join(([columns] if keys else []) + hits + ["count(*) AS _n"])
    many = lambda k: "_n > 1" + (f" AND _key = {keys.index(k)}" if len(keys) > 1 else "")
    found = [(c, check, f"sum(_row{i})") for i, (c, check, _) in enumerate(rows)]
    found += [(c, "unique", f"count_if({many((c,))} AND {_name(c)} IS NOT NULL)") for c in checks.unique]
    found += [(",".join(k), "grain", f"count_if({many(k)})") for k in checks.grain]
    counts = ", ".join(f"coalesce({e}, 0) AS _f{i}" for i, (_, _, e) in enumerate(found))
    lines = ", ".join(f"named_struct('table_name', {_text(table)}, 'column_name', {_text(c)}, 'check_name', '{check}', 'failing_rows', "
                      f"CAST(_f{i} AS BIGINT))" for i, (c, check, _) in enumerate(found))
    grouped = f" GROUP BY {columns}" if keys else ""
    return df.sparkSession.sql(f"SELECT inline(array({lines})) FROM (SELECT {counts} FROM (SELECT {groups} FROM {source}{grouped}))", rows=df)


def report(frames: Mapping[str, Callable[[], DataFrame]], checks: Mapping[str, Checks]) -> DataFrame:
    """The checks of many tables: one scan a table; a frame is asked for only if its table has checks."""
    return union_all([compiled(frames[t](), t, c) for t, c in checks.items() if c != Checks()])


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """``dq_not_null``: nulls of every column."""
    return compiled(df, table, Checks(not_null=tuple(columns)))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """``dq_unique``: number of non-null values that occur more than once."""
    return compiled(df, table, Checks(unique=(column,)))


def accepted_values(df: DataFrame, table: str, column: str, values: Iterable[str] = LIFECYCLE_STAGES) -> DataFrame:
    """``dq_accepted_values``: rows whose value is outside the list (null passes)."""
    return compiled(df, table, Checks(accepted=((column, tuple(values)),)))


def grain(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """``dq_grain``: key combinations that occur more than once."""
    return compiled(df, table, Checks(grain=(tuple(keys),)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(charts: DataFrame, campaigns: DataFrame) -> DataFrame:
    """``val_row_counts``: both row counts from ONE aggregate over the union of the two scans."""
    a = charts.select(F.lit(1).alias("_s"), F.lit(0).alias("_c"))
    b = campaigns.select(F.lit(0).alias("_s"), F.lit(1).alias("_c"))
    return a.unionByName(b).agg(F.coalesce(F.sum("_s"), F.lit(0)).cast("long").alias("spotify_rows"),
                                F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("campaign_rows"))


def preview(df: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """``val_preview``: the first n rows in key order (deterministic LIMIT)."""
    return df.orderBy(*keys).limit(n)


def join_integrity(campaigns: DataFrame, charts: DataFrame) -> DataFrame:
    """``val_join_integrity``: campaigns INNER JOIN charts on (item, market, date), counted.

    Both sides are counted per key first (combined map-side), so a key that many campaigns share
    meets one row and nothing fans out.
    """
    keys = ["spotify_id", "country", "snapshot_date"]
    c = campaigns.groupBy(*keys).agg(F.count(F.lit(1)).alias("_campaigns"))
    s = charts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_charts"))
    return c.join(s, keys).agg(F.coalesce(F.sum(F.col("_campaigns") * F.col("_charts")), F.lit(0)).alias("matching_campaign_rows"))


def generation_mix(campaigns: DataFrame) -> DataFrame:
    """``val_generation_mix``: rows per generation type, most first."""
    return campaigns.groupBy("generation_type").agg(F.count(F.lit(1)).alias("row_count")) \
        .orderBy(F.col("row_count").desc(), "generation_type")


def campaign_orphans(campaigns: DataFrame, charts: DataFrame) -> DataFrame:
    """``campaign_orphans``: campaign rows with no chart row (left anti join); expect none."""
    s = charts.select("spotify_id", "country", "snapshot_date")
    return campaigns.join(s, ["spotify_id", "country", "snapshot_date"], "left_anti")
