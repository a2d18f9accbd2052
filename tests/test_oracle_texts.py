"""Every oracle text binds on empty tables, and the library imports without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pyarrow.parquet as pq
from conftest import ROOT, SF001
from oracle_check import TABLES

from tidemark.plans import registry


def test_every_oracle_text_binds():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        empty = pq.read_schema(f"{SF001}/{t}.parquet").empty_table()
        con.register(f"{t}_rows", empty)
        con.execute(f"CREATE TABLE {t} AS SELECT * FROM {t}_rows")
    bad = {}
    for key, sql in registry.oracle_sql().items():
        try:
            con.execute("EXPLAIN " + sql)
        except duckdb.Error as e:
            bad[key] = str(e).splitlines()[0]
    assert not bad, bad


def test_entry_without_the_operators(tmp_path):
    copy = tmp_path / "repo"
    left_out = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, copy, ignore=left_out)
    (copy / "tidemark" / "llm" / "__pycache__").mkdir(parents=True)     # what a deletion by hand may leave
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 90 and 'pipeline' not in q, len(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(copy)})
    assert done.returncode == 0, done.stderr
