"""The streaming ingest equals the batch cleaning and is restart-safe."""

import os
import tempfile

from tidemark.operators import ingest as I
from tidemark.sources import files as FS
from tidemark.streaming.ingest_stream import ingest_charts_stream, stream_paths


def _raw(spark):
    rows = []
    for i in range(60):
        day = f"2025-0{3 + i % 4}-{10 + i % 18:02d}"
        rows.append(tuple({"spotify_id": f"id{i % 7}", "name": "n", "artists": "a", "country": [" de", "FR", "SE"][i % 3],
                           "snapshot_date": day, "album_release_date": "2020-01-01", "album_name": "al",
                           "is_explicit": "false"}.get(c, str(i % 50)) for c in I.CHART_COLUMNS))
    return spark.createDataFrame(rows, FS.string_schema(I.CHART_COLUMNS)).repartition(5)


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="tidemark-stream-")
    raw_path = os.path.join(base, "raw")
    FS.write_csv(_raw(spark), raw_path)
    out, ckpt = stream_paths(os.path.join(base, "run"))
    streamed = ingest_charts_stream(spark, raw_path, out, ckpt, markets=["DE", "FR"], files_per_trigger=2)
    batch = I.clean_charts(FS.read_csv(spark, raw_path, I.CHART_COLUMNS), ["DE", "FR"])
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    # second run on the same checkpoint: every file was already committed
    again = ingest_charts_stream(spark, raw_path, out, ckpt, markets=["DE", "FR"], files_per_trigger=2)
    assert again.count() == batch.count()


def test_files_in_any_order_give_the_batch_result(spark, tmp_path):
    """The window moves forward: late files still count, rows that fall out expire, a market that is not wanted moves it too."""
    import random

    from tidemark.streaming.ingest_stream import read_window, state_of, take_batch
    days = [("2025-01-05", "DE"), ("2025-03-01", "DE"), ("2025-03-02", "FR"), ("2025-05-30", "DE"), ("2025-05-31", "XX"), ("bad", "DE"),
            ("2025-03-03", "DE"), ("2025-02-28", "FR"), (None, "FR"), ("2024-12-01", "DE")]
    files = []
    for i, (day, market) in enumerate(days):
        row = tuple({"spotify_id": f"id{i}", "country": market, "snapshot_date": day}.get(c, "1") for c in I.CHART_COLUMNS)
        files.append(spark.createDataFrame([row, row], FS.string_schema(I.CHART_COLUMNS)))
    whole = files[0]
    for f in files[1:]:
        whole = whole.unionByName(f)
    want = sorted(map(tuple, I.clean_charts(whole, ["DE", "FR"]).collect()))
    assert 0 < len(want) < 2 * len(days) - 6
    for seed in range(4):
        table, order = str(tmp_path / f"t{seed}"), list(range(len(files)))
        random.Random(seed).shuffle(order)
        for batch, i in enumerate(order):
            take_batch(files[i], batch, table, ["DE", "FR"])
            take_batch(files[i], batch, table, ["DE", "FR"])        # tried again after the commit
        assert sorted(map(tuple, read_window(spark, table).collect())) == want, order
        assert state_of(spark, table)["max_date"] == "2025-05-31"


def test_new_files_move_the_window(spark, tmp_path):
    raw = tmp_path / "raw"
    frame = lambda day: spark.createDataFrame([tuple({"spotify_id": "a", "country": "DE", "snapshot_date": day}.get(c, "1") for c in I.CHART_COLUMNS)],
                                              FS.string_schema(I.CHART_COLUMNS))
    out, ckpt = stream_paths(str(tmp_path / "run"))
    held = []
    for day in ("2025-01-01", "2025-03-01", "2025-05-01", "2025-01-02"):
        frame(day).write.mode("append").option("header", True).csv(str(raw))
        got = ingest_charts_stream(spark, str(raw), out, ckpt, markets=["DE"])
        held.append(sorted(str(r.SNAPSHOT_DATE) for r in got.collect()))
    assert held == [["2025-01-01"], ["2025-01-01", "2025-03-01"], ["2025-03-01", "2025-05-01"], ["2025-03-01", "2025-05-01"]]


def test_a_stream_without_dates_fails(spark, tmp_path):
    import pytest
    row = tuple({"spotify_id": "a", "country": "DE", "snapshot_date": "bad"}.get(c, "1") for c in I.CHART_COLUMNS)
    spark.createDataFrame([row], FS.string_schema(I.CHART_COLUMNS)).write.option("header", True).csv(str(tmp_path / "raw"))
    out, ckpt = stream_paths(str(tmp_path / "run"))
    with pytest.raises(ValueError, match="date"):
        ingest_charts_stream(spark, str(tmp_path / "raw"), out, ckpt, markets=["DE"])
