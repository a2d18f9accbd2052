"""SparkSession construction and lineage cuts."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A broadcast only happens below this measured size (dimension-sized
    # sides: nation, channel benchmarks, one-row aggregates); fact-sized sides
    # (orders, part, campaigns) take a shuffle join whose reducers run in
    # parallel.  AQE re-checks with the real sizes at runtime.
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for lineage cuts and written tables, always ``sc.getCheckpointDir()``.

    It comes from ``spark.checkpoint.dir``.  Where that is unset, a local master
    gets ``fallback`` or a fresh scratch folder (local runs and tests); any other
    master is an error, as executors do not share the driver's disk.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not current:
            current = fallback or tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and drop its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: With it, Spark removes the shuffle files of a statement when the statement ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_removing: dict[str, list] = {}          # by application: how many blocks are open, the setting before them
_counting = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements that begin in this block leave no shuffle files behind.

    Otherwise these stay until the driver's garbage collection comes upon them, and the disk holds
    the shuffles of all tables that a query writes at once.  For writes: nothing reads their
    shuffles again.
    """
    app = spark.sparkContext.applicationId
    with _counting:
        held = _removing.setdefault(app, [0, None])
        if not held[0]:
            held[1] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _counting:
            held[0] -= 1
            if not held[0]:
                spark.conf.unset(SHUFFLE_CLEANUP) if held[1] is None else spark.conf.set(SHUFFLE_CLEANUP, held[1])


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but stays columnar: later reads prune
    columns, and a lost executor reads the files again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
