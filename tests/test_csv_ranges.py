"""CSV with quoted line breaks: many tasks give the rows of the whole-file reader."""

import collections
import csv
import io
import random

import pytest

from tidemark.sources import files as FS
from tidemark.sources.csv_ranges import UnevenQuotes, ranges, read_quoted_csv, records

COLUMNS = ["id", "name", "note"]


def field(rng):
    kind = rng.randrange(9)
    if kind == 0:
        return ""
    if kind == 1:
        return '""'
    text = "".join(rng.choices(["a", "é", "中", " ", "7", "x y", "word"], k=rng.randint(1, 12)))
    if kind < 5:
        return text.strip() or "z"
    inside = [text, rng.choice(["\n", ",", '""', "\n\n", "\r\n", '""\n', "\n,"]), text]
    if kind == 8:
        inside *= rng.randint(2, 400)           # records longer than a range
    return '"' + "".join(inside) + '"'


def write(path, seed, rows, end):
    rng = random.Random(seed)
    lines = [",".join(COLUMNS)] + [f"{i},{field(rng)},{field(rng)}" for i in range(rows)] + ([""] if seed % 2 else [])
    path.write_bytes((end.join(lines) + (end if seed % 3 else "")).encode())


def rows_of(df, crlf=True):
    """Rows with their counts; ``crlf=False``: with LF for CRLF, as the whole-file reader has it inside fields of CRLF files."""
    return collections.Counter(tuple(v if crlf or v is None else v.replace("\r\n", "\n") for v in r) for r in df.collect())


@pytest.fixture
def small_ranges(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_equal_the_whole_file_reader(spark, tmp_path, small_ranges, end):
    for i, n in enumerate((250, 400, 0, 1)):
        write(tmp_path / f"{i}.csv", i, n, end)
    path = str(tmp_path)
    table = ranges(spark, path).collect()
    assert len(table) > 20 and sum(r["before"] % 2 for r in table) > 3
    got = read_quoted_csv(spark, path, COLUMNS)
    assert got.rdd.getNumPartitions() > 20
    want = rows_of(FS.read_csv(spark, path, COLUMNS, whole_files=True), end == "\n")
    assert sum(want.values()) == 651 and rows_of(got, end == "\n") == want
    texts = [(tmp_path / f"{i}.csv").read_bytes().decode() for i in range(4)]
    exact = [r for t in texts for r in list(csv.reader(io.StringIO(t, newline="")))[1:] if r]
    assert rows_of(got.fillna("")) == collections.Counter(map(tuple, exact))


def test_plain_reader_would_break_the_records(spark, tmp_path, small_ranges):
    write(tmp_path / "a.csv", 1, 300, "\n")
    assert rows_of(FS.read_csv(spark, str(tmp_path), COLUMNS)) != rows_of(read_quoted_csv(spark, str(tmp_path), COLUMNS))


def test_odd_quotes_and_other_heads_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,5" disc,x\n')
    with pytest.raises(UnevenQuotes, match="a.csv"):
        read_quoted_csv(spark, str(tmp_path), COLUMNS)
    (tmp_path / "a.csv").write_text("id,nome,note\n1,x,y\n")
    with pytest.raises(Exception, match="nome"):
        read_quoted_csv(spark, str(tmp_path), COLUMNS).collect()


def test_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_quoted_csv(spark, str(tmp_path), COLUMNS).collect() == []


def test_head_longer_than_a_range_is_left_out(spark, tmp_path, small_ranges):
    head = 'id,"' + "long name\n" * 2000 + '"\n'
    (tmp_path / "a.csv").write_text(head + "".join(f'{i},"v\n{i}"\n' for i in range(3000)))
    assert sum(r["before"] % 2 for r in ranges(spark, str(tmp_path)).collect()) > 2
    got = collections.Counter(r["record"] for r in records(spark, str(tmp_path)).collect())
    assert got == collections.Counter(f'{i},"v\n{i}"' for i in range(3000))
