"""CSV files with quoted line breaks, read in parallel by byte ranges.

Spark splits a CSV file at line ends, which breaks records whose fields hold line breaks, and with
``multiLine`` it reads a file whole in one task.  Here the ranges stay:

1. Spark's text source cuts the files into ranges of lines.  Per range, one aggregate counts
   the quote signs and finds the first and the last line with an odd number of them (one row a
   range leaves the tasks).
2. A line starts a record exactly if the number of quote signs before it in its file is even.  The
   prefix sums over the ranges of a file say whether a range starts inside a record.
3. Every task reads its ranges again and glues lines to records, carrying one record at a time.
   What reaches over a range's edge is left out there: a range that starts inside a record gives its
   lines up to the first odd one, a range that ends inside a record those from the last odd one.
   A filter on the lines, all in the JVM, finds these; joined per range they are at most two
   fragments, which one small grouping by file joins in order.
4. Records are parsed by Spark's own CSV parser (``from_csv``).

Quote signs must stand around fields or doubled inside them (RFC 4180), as the writer here
writes them.  A file with an odd number of them is an error, not a guess.  Lines end with LF
or CRLF; line breaks inside fields stay as they are.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import write_once

RECORD = "record string"


class UnevenQuotes(ValueError):
    pass


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their range; a file goes by the hash of its name, to keep rows short."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(F.input_file_name()).alias("file"), F.input_file_block_start().alias("at"), F.col("value").alias("line"))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a number that ascends within a range, the same in every read of the same ranges."""
    return _lines(spark, path).withColumn("id", F.monotonically_increasing_id())


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """One row a range: file, at (first byte), quotes, first_id, first_odd and last_odd (lines with an odd
    number of quote signs), before (quote signs of the file before the range)."""
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    odd = F.when(F.col("n") % 2 == 1, F.col("id"))
    counts = _numbered(spark, path).withColumn("n", quotes).groupBy("file", "at").agg(
        F.sum("n").alias("quotes"), F.min("id").alias("first_id"), F.min(odd).alias("first_odd"), F.max(odd).alias("last_odd"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)     # one row a range
    return counts.withColumn("before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))


def _parts(batch: pa.RecordBatch):
    """The runs of lines of one range in a batch: ((file, at), lines)."""
    file, at = batch.column("file").to_numpy(), batch.column("at").to_numpy()
    new = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1
    for i, j in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
        if i < j:
            yield (int(file[i]), int(at[i])), batch.column("line").slice(i, j - i)


def _glue(inside: set[tuple[int, int]], columns: Sequence[str] | None):
    """Lines in file order -> the records that lie in one range; whole arrays at a time.

    ``inside`` holds the ranges that start inside a record.  The head of a file must name
    ``columns`` (None: any) and is left out.
    """
    none = pa.array([], pa.string())

    def joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
        """Lines up to each of ``ends`` (the last line of a record) as one text."""
        if len(ends) == len(lines):
            return lines
        offsets = pa.array(np.concatenate([[0], ends + 1]), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")

    def check(head: str) -> None:
        found = next(csv.reader(io.StringIO(head, newline="")), [])
        if columns is not None and found != list(columns):
            raise ValueError(f"the head of a file names {found}, not {list(columns)}")

    def run(batches):
        where, held, open_, starts, first = None, none, False, True, False
        for batch in batches:
            for here, lines in _parts(batch):
                if here != where:                           # what is held goes on in another range
                    where, held, open_ = here, none, here in inside
                    starts, first = not open_, here[1] == 0
                odd = np.asarray(pc.count_substring(lines, '"')) % 2
                after = (np.cumsum(odd) + open_) % 2        # 1: the line ends inside a record
                ends = np.flatnonzero(after == 0) + len(held)
                lines, open_ = pa.concat_arrays([held, lines]), bool(after[-1])
                if not len(ends):
                    held = lines
                    continue
                held = lines.slice(ends[-1] + 1)
                texts = joined(lines.slice(0, ends[-1] + 1), ends)
                if starts and first:
                    check(texts[0].as_py().removesuffix("\r"))
                if not starts or first:                     # the head, or the end of a record of an earlier range
                    texts = texts.slice(1)
                starts, first = True, False
                if pc.any(pc.ends_with(texts, "\r")).as_py():
                    texts = pc.replace_substring_regex(texts, r"\r\z", "")
                yield pa.RecordBatch.from_arrays([texts], names=["record"])

    return run


def _fragments(spark: SparkSession, path: str, table: DataFrame) -> DataFrame:
    """file, at, part, head, record: what the ranges of ``table`` hold of records that reach over an edge; part 0
    goes on with a record, part 1 starts one."""
    edges = table.select("file", "at", "first_id", "first_odd", "last_odd", F.expr("before % 2 = 1").alias("inside"),
                         F.expr("(before + quotes) % 2 = 1 and last_odd is not null").alias("opens")).where("inside or opens")
    lines = _numbered(spark, path).join(F.broadcast(edges), ["file", "at"])         # one row a range at most
    lines = lines.withColumn("part", F.expr("case when opens and id >= last_odd then 1 when inside and (first_odd is null or id <= first_odd) then 0 end"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"])
    return lines.where("part is not null").groupBy("file", "at", "part").agg(
        F.max(F.expr("at = 0 and part = 1 and last_odd = first_id")).alias("head"), F.array_join(texts, "\n").alias("record"))


def records(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """record: the text of every CSV record under ``path`` without heads, blank lines and line ends."""
    table = write_once(ranges(spark, path), "csv-ranges")
    uneven = [r["file"] for r in table.groupBy("file").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").limit(5).collect()]
    if uneven:
        named = spark.read.text(path).select(F.input_file_name().alias("name")).where(F.xxhash64("name").isin(uneven)).distinct()
        raise UnevenQuotes("files with an odd number of quote signs: " + ", ".join(sorted(r["name"] for r in named.collect())))
    # only ranges that start inside a record reach the driver
    inside = {(r["file"], r["at"]) for r in table.where("before % 2 = 1").select("file", "at").collect()}
    found = _lines(spark, path).mapInArrow(_glue(inside, columns), RECORD)
    if inside:
        order = Window.partitionBy("file").orderBy("at", "part")            # fragments: at most two a range
        pieces = _fragments(spark, path, table).withColumn("nth", F.sum("part").over(order))
        parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "part", "record"))), lambda x: x["record"])
        joined = pieces.groupBy("file", "nth").agg(F.max("head").alias("head"), F.array_join(parts, "\n").alias("record"))
        found = found.unionByName(joined.where("not head").select(F.regexp_replace("record", "\r$", "").alias("record")))
    return found.where("record <> ''")


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV with quoted line breaks, every column as text: the rows of the whole-file reader, from many tasks."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv("record", schema, {"escape": '"', "multiLine": "true"})
    return records(spark, path, columns).select(parsed.alias("r")).select("r.*")
