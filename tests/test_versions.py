"""Tables replaced in one step: failed and killed writes, readers in flight, counts, fingerprints."""

import os
import signal
import subprocess
import sys
import time

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from tidemark.sources import files as FS
from tidemark.sources import versions as V


def rows(spark, path):
    return sorted(r[0] for r in FS.read_written(spark, path).collect())


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.current(spark, path) is None
    FS.write_table(spark.range(5), path)
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        FS.write_table(bad, path)
    assert rows(spark, path) == [0, 1, 2, 3, 4]
    v = V.replace(spark.range(2), path, note={"week": "x"})
    assert v.rows == 2 and rows(spark, path) == [0, 1] and V.current(spark, path) == v


def test_files_without_a_pointer_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    FS.write_table(spark.range(3), path)
    V.write_version(spark.range(50), path)              # ended between the write and the commit
    assert rows(spark, path) == [0, 1, 2]


def test_a_killed_process_leaves_the_old_rows(spark, tmp_path):
    path, started = str(tmp_path / "t"), tmp_path / "started"
    FS.write_table(spark.range(4), path)
    code = f"""
import pathlib, time
from tidemark.session import build_session
from tidemark.sources import files
spark = build_session("local[1]")
def slow(batches):
    for b in batches:
        pathlib.Path({str(started)!r}).touch()
        time.sleep(60)
        yield b
files.write_table(spark.range(9).mapInArrow(slow, "id long"), {path!r})
"""
    run = subprocess.Popen([sys.executable, "-c", code], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, start_new_session=True,
                           stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        for _ in range(600):
            if started.exists() or run.poll() is not None:
                break
            time.sleep(0.1)
        assert started.exists()
        assert any(x.startswith("v-") for x in os.listdir(path)) and len([x for x in os.listdir(path) if x.startswith("v-")]) == 2
    finally:
        os.killpg(run.pid, signal.SIGKILL)
        run.wait()
    assert rows(spark, path) == [0, 1, 2, 3]
    FS.write_table(spark.range(1), path)                 # the next replacement clears what the killed one left
    assert rows(spark, path) == [0] and len([x for x in os.listdir(path) if x.startswith("v-")]) == 2


def test_readers_in_flight_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    FS.write_table(spark.range(3), path)
    old = FS.read_written(spark, path)
    FS.write_table(spark.range(10, 12), path)
    assert old.count() == 3 and rows(spark, path) == [10, 11]
    for n in (1, 2, 3):
        FS.write_table(spark.range(n), path)
    assert len([x for x in os.listdir(path) if x.startswith("v-")]) == 1 + V.KEPT_BEFORE


def test_rows_are_counted_by_the_write(spark, tmp_path):
    df = spark.range(1000).withColumn("week", F.col("id") % 3)
    assert V.replace(df, str(tmp_path / "a"), ["week"]).rows == 1000
    assert V.replace(df.where("id < 0"), str(tmp_path / "b")).rows == 0
    assert V.current(spark, str(tmp_path / "a")).read(spark).where("week = 1").count() == 333


def test_table_follows_its_inputs(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    (source / "x.csv").write_text("1\n2\n")
    made = []

    def make():
        made.append(1)
        return spark.read.schema("a int").csv(str(source))

    now = lambda: V.table(spark, path, V.fingerprint(spark, [str(source)]), make)
    assert now().rows == 2 and now().rows == 2 and len(made) == 1
    (source / "y.csv").write_text("3\n")
    assert now().rows == 3 and len(made) == 2
    (source / "x.csv").write_text("9\n")
    assert now().rows == 2 and len(made) == 3
    assert V.fingerprint(spark, [str(tmp_path / "none")]) != V.fingerprint(spark, [str(source)])
