"""Driver contract and the DuckDB oracle (sf0.001) for the whole registry."""

import json
import os

import pytest
from conftest import ROOT, SF001

from tidemark.plans import registry


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "top_track_name" in df.columns
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 90


def test_doubles_file_is_current(spark):
    with open(os.path.join(ROOT, "tidemark", "plans", "doubles.json")) as fh:
        declared = json.load(fh)
    actual = registry.double_columns(spark, SF001)
    assert declared == actual


@pytest.mark.parametrize("chunk", range(4))
def test_oracle_sf0001(spark, chunk):
    from oracle_check import compare, duck
    keys = sorted(registry.REG)[chunk::4]
    res = compare(spark, SF001, keys, duck(SF001))
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO-SQL")}
    assert not bad, bad


def test_written_tables_follow_their_inputs(spark, tmp_path):
    """Rewrite an input: the next query sees it.  Unchanged inputs: the written table stays."""
    import shutil

    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    for t in registry.SOURCES:
        shutil.copy(f"{SF001}/{t}.parquet", tmp_path / f"{t}.parquet")
    sf = str(tmp_path)
    charts = registry.tables(spark, sf).charts
    n, folder = charts.count(), charts.inputFiles()[0].rsplit("/", 1)[0]
    assert registry.tables(spark, sf).charts.inputFiles()[0].startswith(folder)
    lines = pq.read_table(tmp_path / "lineitem.parquet")
    pq.write_table(lines.filter(pc.less(lines["l_orderkey"], 300)), tmp_path / "lineitem.parquet")
    assert 0 < registry.tables(spark, sf).charts.count() < n
    assert registry.queries()["val_row_counts"](spark, sf).first().spotify_rows < n
    before = registry.tables(spark, sf).charts.inputFiles()
    registry.refresh()
    assert registry.tables(spark, sf).charts.inputFiles() != before
