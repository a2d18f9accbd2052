"""Tables that are replaced in one step, and what they were made from.

A table is a folder of versions and one pointer::

    <table>/v-<id>/...        files of a version
    <table>/_CURRENT          JSON: the version that readers see, its rows, its inputs

``replace`` writes a new version beside the old one and then renames a finished pointer over
the old pointer.  A write that fails or is killed leaves the old pointer, so readers see the
old rows; its files are left over until the next replacement clears all versions but the new
one and the one before it (a reader that still has the old pointer finds its files).

Rows are counted by the write itself (``DataFrame.observe``), on the side of the last
exchange, where a task's figures count once however often it was tried.

``fingerprint`` sums up input files by name, size and time.  Stored with a version, it
tells whether the table is still that of its inputs: ``table`` builds it anew if not.

Files are listed, read and renamed with the file system that Spark itself uses for the path.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shuffles_removed

POINTER = "_CURRENT"
KEPT_BEFORE = 1               # versions before the current one that stay for readers


@dataclass(frozen=True)
class Version:
    folder: str
    rows: int
    inputs: str | None = None
    note: dict = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.folder)


# -- files ---------------------------------------------------------------------------
def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def put(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file at ``path`` in one step, over what is there."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    fresh, target = _path(spark, f"{path}.{uuid.uuid4().hex}"), _path(spark, path)
    out = _files(spark, path).create(fresh, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(_files(spark, path).getUri(), conf).rename(fresh, target, how)


def get(spark: SparkSession, path: str) -> str | None:
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return None
    source = files.open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """Names, sizes and times of all files under ``paths``, as one digest; a missing path counts as such."""
    seen = []
    for path in sorted(paths):
        files = _files(spark, path)
        if not files.exists(_path(spark, path)):
            seen.append((path, "missing"))
            continue
        found = files.listFiles(_path(spark, path), True)
        while found.hasNext():
            f = found.next()
            seen.append((path, f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(seen, key=str)).encode()).hexdigest()


# -- versions ------------------------------------------------------------------------
def write_parquet(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    w.parquet(folder)


def write_csv(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> None:
    (df.write.option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder))


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that readers of the table at ``path`` see; None if it was never written."""
    text = get(spark, f"{path}/{POINTER}")
    if text is None:
        return None
    held = json.loads(text)
    return Version(**{**held, "folder": f"{path}/{held['folder']}"})


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), write: Callable = write_parquet) -> Version:
    """Write the files of a new version, which nobody sees until ``commit``.

    Partitioned writes first REBALANCE on the partition columns: rows of one value meet in few
    tasks (few files a folder), and AQE splits a hot value and merges small ones.
    """
    folder = f"{path}/v-{uuid.uuid4().hex}"
    counted = Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    with shuffles_removed(df.sparkSession):
        write(df.observe(counted, F.count(F.lit(1)).alias("rows")), folder, partition_by)
    return Version(folder, counted.get["rows"])


def commit(spark: SparkSession, path: str, version: Version) -> Version:
    """Let readers of ``path`` see ``version`` from now on, and clear versions that none can still read."""
    before = current(spark, path)
    put(spark, f"{path}/{POINTER}", json.dumps({**asdict(version), "folder": version.folder.rsplit("/", 1)[1]}))
    stay = {version.folder.rsplit("/", 1)[1]}
    if before and KEPT_BEFORE:
        stay.add(before.folder.rsplit("/", 1)[1])
    files = _files(spark, path)
    for status in files.listStatus(_path(spark, path)):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in stay:
            files.delete(status.getPath(), True)
    return version


def drop(spark: SparkSession, folder: str) -> None:
    """Delete the files of a version that no pointer names any more."""
    _files(spark, folder).delete(_path(spark, folder), True)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), write: Callable = write_parquet,
            inputs: str | None = None, note: dict | None = None) -> Version:
    """Replace the table at ``path`` by the rows of ``df``; until the end readers see the old rows."""
    new = write_version(df, path, partition_by, write)
    return commit(df.sparkSession, path, Version(new.folder, new.rows, inputs, note or {}))


_building = threading.RLock()     # queries may be called from several threads


def table(spark: SparkSession, path: str, inputs: str, make: Callable[[], DataFrame],
          partition_by: Sequence[str] = (), write: Callable = write_parquet) -> Version:
    """The table at ``path`` if it was made from ``inputs``, else made anew by ``make``."""
    with _building:
        now = current(spark, path)
        if now is None or now.inputs != inputs:
            now = replace(make(), path, partition_by, write, inputs)
        return now
