"""Raw file cleaning and staging on hand fixtures."""

import datetime as dt
import os
import tempfile

from tidemark.operators import ingest as I
from tidemark.operators import staging as S
from tidemark.sources import files as FS


def _raw(spark, rows):
    base = {c: "1" for c in I.CHART_COLUMNS}
    base.update(spotify_id="id", name="n", artists="a", country="DE", snapshot_date="2025-06-11",
                album_release_date="2020-01-01", album_name="al", is_explicit="false")
    data = []
    for r in rows:
        rec = dict(base)
        rec.update(r)
        data.append(tuple(rec[c] for c in I.CHART_COLUMNS))
    return spark.createDataFrame(data, FS.string_schema(I.CHART_COLUMNS))


def test_clean_charts_rules(spark):
    raw = _raw(spark, [
        dict(spotify_id="keep", country=" de "),                       # trimmed + upper -> kept
        dict(spotify_id="se", country="SE"),                           # other market
        dict(spotify_id="nullc", country=None, snapshot_date="2025-06-20"),  # dropped, but sets max date
        dict(spotify_id="edge", snapshot_date="2025-03-22"),           # max - 90 -> kept
        dict(spotify_id="old", snapshot_date="2025-03-21"),            # max - 91 -> dropped
        dict(spotify_id="bad", snapshot_date="not a date"),            # dropped
        dict(spotify_id="partial", album_release_date="1999"),         # album null, kept
        dict(spotify_id="rank", daily_rank="abc"),                     # rank null, kept
        dict(spotify_id="  "),                                         # '' kept
        dict(spotify_id="\tpad　"),                                # unicode padding stripped
        dict(spotify_id="q", artists="Alfa, Manu"),                    # comma in a field
    ])
    out = {r.SPOTIFY_ID: r for r in I.clean_charts(raw, ["DE"]).collect()}
    assert I.max_date(raw).first().max_date == dt.date(2025, 6, 20)
    assert {"keep", "edge", "partial", "rank", "", "pad", "q"} <= set(out)
    assert not {"se", "nullc", "old", "bad"} & set(out)
    assert out["keep"].COUNTRY == "DE"
    assert out["partial"].ALBUM_RELEASE_DATE is None
    assert out["rank"].DAILY_RANK is None and out["keep"].DAILY_RANK == 1
    assert list(I.clean_charts(raw, ["DE"]).columns) == [c.upper() for c in I.CHART_COLUMNS]


def test_csv_round_trip_with_quotes(spark):
    raw = _raw(spark, [dict(spotify_id="q", artists='He said "hi", twice', name="line\nbreak")])
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-csv-"), "charts")
    FS.write_csv(raw, path)
    back = FS.read_csv(spark, path, I.CHART_COLUMNS, multiline=True).first()
    assert back.artists == 'He said "hi", twice' and back.name == "line\nbreak"


def test_pandas_null_tokens_opt_in(spark):
    raw = _raw(spark, [dict(spotify_id="None", country="NA")])
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-csv-"), "charts")
    FS.write_csv(raw, path)
    assert FS.read_csv(spark, path, I.CHART_COLUMNS).first().spotify_id == "None"
    nulled = FS.read_csv(spark, path, I.CHART_COLUMNS, pandas_null_tokens=True).first()
    assert nulled.spotify_id is None and nulled.country is None


def test_staging_keeps_blank_keys_and_types(spark):
    raw = _raw(spark, [dict(spotify_id="  ", daily_rank="3.0"), dict(spotify_id="x", snapshot_date=None)])
    table = I.project_order(raw)
    staged = S.stage_charts(table).collect()
    assert len(staged) == 1 and staged[0].spotify_id == "" and staged[0].daily_rank == 3
    assert S.stage_charts(table, drop_blank_keys=True).count() == 0


def test_anchor_csv_requires_columns(spark):
    import pytest
    df = spark.createDataFrame([("a",)], "SPOTIFY_ID string")
    with pytest.raises(ValueError, match="anchor file lacks: NAME"):
        I.anchors_from_filtered(df)


def test_numbers_keep_their_value(spark):
    raw = _raw(spark, [dict(spotify_id="a", duration_ms="3000000000", daily_rank="3.7", popularity="-2.5", key="9007199254740993"),
                       dict(spotify_id="b", duration_ms="", daily_rank="x", popularity="2.0", key="nan")])
    for df in (I.project_order(I.to_numeric(raw)), S.stage_charts(I.project_order(raw))):
        rows = df.toDF(*[c.lower() for c in df.columns]).orderBy("spotify_id").collect()
        key = "key" if "key" in rows[0].asDict() else "musical_key"
        assert [rows[0][c] for c in ("duration_ms", "daily_rank", "popularity", key)] == [3000000000, 4, -3, 9007199254740993]
        assert [rows[1][c] for c in ("duration_ms", "daily_rank", "popularity", key)] == [None, None, 2, None]
    base = {c: "1" for c in I.CAMPAIGN_COLUMNS} | {"SNAPSHOT_DATE": "2025-06-11", "IMPRESSIONS": "3000000000",
                                                   "CLICKS": "2147483648", "ATTRIBUTED_STREAMS": "5000000000.5"}
    camp = spark.createDataFrame([tuple(base[c] for c in I.CAMPAIGN_COLUMNS)], FS.string_schema(I.CAMPAIGN_COLUMNS))
    for df in (I.clean_campaigns(camp), S.stage_campaigns(camp)):
        r = df.toDF(*[c.lower() for c in df.columns]).first()
        assert (r.impressions, r.clicks, r.attributed_streams) == (3000000000, 2147483648, 5000000001)


def test_no_valid_date_is_an_error(spark):
    import pytest
    raw = _raw(spark, [dict(snapshot_date="bad"), dict(snapshot_date=None)])
    with pytest.raises(Exception, match="no row with a date"):
        I.clean_charts(raw, ["DE"]).collect()
    with pytest.raises(ValueError, match="no row with a date"):
        I.require_max_date(raw)


def test_csv_of_one_file_is_split_by_default(spark, tmp_path):
    raw = _raw(spark, [dict(spotify_id=f"id{i}", name=" padded ") for i in range(4000)]).coalesce(1)
    path = str(tmp_path / "charts")
    FS.write_csv(raw, path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        back = FS.read_csv(spark, path, I.CHART_COLUMNS)
        assert back.rdd.getNumPartitions() > 1
        assert back.where("name = ' padded '").count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
